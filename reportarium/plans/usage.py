"""Who owns and who uses each report.

The audit is the large table, and some reports have a large share of it. Every plan
here first reduces it to distinct (document, user) pairs: duplicates go before the
shuffle, the shuffle spreads one document's users, and what is joined afterwards is
counted per document and unit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportarium.functions.conditions import any_true, effective_owner, normal_key, usage_category
from reportarium.operators.keys import latest_per_key, look_up

_PROFILE = ("bu", "bu_group", "is_controller", "is_manager")


def audit_with_category(audit: DataFrame, directory: DataFrame) -> DataFrame:
    """Audit rows with usage category and the user's profile."""
    profiled = look_up(
        audit,
        normal_key(F.col("user_name")),
        directory,
        normal_key(F.col("user_id")),
        _PROFILE,
    )
    return profiled.withColumn("usage_category", usage_category(F.col("event_type")))


def category_counts(audit: DataFrame) -> DataFrame:
    """Events by category, event type."""
    return audit.groupBy(
        usage_category(F.col("event_type")).alias("usage_category"), "event_type"
    ).agg(F.count("*").alias("events"))


def _scope_ids(scope: DataFrame) -> DataFrame:
    return scope.select("document_id").filter("document_id is not null")


def document_users(audit: DataFrame, directory: DataFrame, scope: DataFrame) -> DataFrame:
    """Users per document and unit: ``document_id, bu, bu_group, controller, users``.

    Only documents in scope, only rows with a user. Users are counted by the name as
    written in the audit; a user has one directory entry, so counts over units add up.
    """
    pairs = (
        audit.select("document_id", "user_name")
        .filter("user_name is not null")
        .distinct()
        .join(_scope_ids(scope), "document_id", "left_semi")
    )
    profiled = look_up(
        pairs,
        normal_key(F.col("user_name")),
        directory,
        normal_key(F.col("user_id")),
        ["bu", "bu_group", "is_controller"],
    )
    return profiled.groupBy("document_id", "bu", "bu_group").agg(
        any_true(F.col("is_controller")).alias("controller"), F.count("*").alias("users")
    )


def owner_list(
    metadata: DataFrame, directory: DataFrame, scope: DataFrame, latest: bool = True
) -> DataFrame:
    """Documents in scope with the profile of their effective owner.

    ``latest`` takes the newest snapshot per document; otherwise every distinct state.
    """
    state = ["document_id", "document_name", "full_path", "scheduled", "file_location"]
    wanted = metadata.select(*state, "created_by", "last_author", "ingestion_ts").join(
        _scope_ids(scope), "document_id", "left_semi"
    )
    rows = latest_per_key(wanted, ["document_id"], "ingestion_ts") if latest else wanted
    owner = normal_key(effective_owner(F.col("created_by"), F.col("last_author")))
    owned = look_up(
        rows.select(*state, owner.alias("owner")).distinct() if not latest else rows.withColumn("owner", owner),
        F.col("owner"),
        directory,
        normal_key(F.col("user_id")),
        _PROFILE,
    )
    named = owned.select(*state, *(F.col(p).alias(f"owner_{p}") for p in _PROFILE))
    return named if latest else named.distinct()


def shortlist(scope: DataFrame, audit: DataFrame, limit: int | None = None) -> DataFrame:
    """Documents in scope that occur in the audit; ``limit`` takes the first by id."""
    audited = audit.select(F.trim("document_id").alias("__id")).distinct()
    ids = _scope_ids(scope).distinct()
    found = ids.join(audited, F.trim(ids.document_id) == F.col("__id"), "left_semi").select(
        F.col("document_id").alias("shortlist_id")
    )
    return found if limit is None else found.orderBy("shortlist_id").limit(limit)


def distinct_consumers(scope: DataFrame, audit: DataFrame) -> DataFrame:
    """Users per document in scope, each counted once however the login is spelled."""
    user = normal_key(F.col("user_name")).alias("user")
    pairs = audit.select(F.trim("document_id").alias("document_id"), user).distinct()
    ids = _scope_ids(scope).select(F.trim("document_id").alias("document_id")).distinct()
    counted = pairs.groupBy("document_id").agg(F.count("user").alias("distinct_users"))
    return ids.join(counted, "document_id")


def shortlist_profile(scope: DataFrame, audit: DataFrame, directory: DataFrame) -> DataFrame:
    """Shortlisted documents with their users, units and the total in scope."""
    pairs = audit.select(F.trim("document_id").alias("__id"), "user_name").distinct()
    profiled = look_up(
        pairs, normal_key(F.col("user_name")), directory, normal_key(F.col("user_id")), ["bu"]
    )
    counted = (
        profiled.groupBy("__id", "bu")
        .agg(F.count("user_name").alias("users"))
        .groupBy("__id")
        .agg(F.sum("users").alias("user_count"), F.count("bu").alias("bu_count"))
    )
    ids = _scope_ids(scope).distinct()
    total = ids.agg(F.count("*").alias("total"))
    return ids.join(counted, F.trim(ids.document_id) == F.col("__id")).select(
        F.col("document_id").alias("shortlist_id"),
        "user_count",
        "bu_count",
        total.scalar().alias("total_in_scope"),
    )


def shortlist_share(scope: DataFrame, audit: DataFrame) -> DataFrame:
    """Shortlisted documents as a share of those in scope; one row."""
    total = _scope_ids(scope).agg(F.countDistinct("document_id").alias("total"))
    return shortlist(scope, audit).agg(
        F.count("*").alias("shortlisted"),
        total.scalar().alias("total_in_scope"),
        F.round(F.count("*") / total.scalar(), 6).alias("share"),
    )


def usage_matrix(
    metadata: DataFrame, audit: DataFrame, directory: DataFrame, scope: DataFrame
) -> DataFrame:
    """One row per document and consuming unit, with the owner's side and distinct users.

    Users are counted before the owner is joined: the owner is one row per document and
    cannot change a count, so only (document, unit) rows meet it.
    """
    users = document_users(audit, directory, scope)
    owners = owner_list(metadata, directory, scope)
    return users.join(owners, "document_id", "left").select(
        "document_id",
        "document_name",
        F.col("full_path").alias("folder_path"),
        F.col("file_location").alias("csv_file_location"),
        "scheduled",
        F.col("owner_bu").alias("ownedby_bu"),
        F.col("owner_bu_group").alias("ownedby_bu_group"),
        F.col("owner_is_manager").alias("ownedby_manager"),
        F.col("owner_is_controller").alias("ownedby_controller"),
        F.col("bu").alias("accessed_bu"),
        F.col("bu_group").alias("accessed_bu_group"),
        F.col("controller").alias("accessed_by_controller"),
        F.col("users").alias("accessed_users"),
    )


def usage_pairs(
    metadata: DataFrame, audit: DataFrame, directory: DataFrame, scope: DataFrame
) -> DataFrame:
    """Older usage list: distinct (document state, consuming unit) pairs, in order.

    Every recorded state of a document counts, not the latest only. The accessor's
    controller flag is that of the accessing users.
    """
    known = metadata.select("document_id")
    in_scope = _scope_ids(scope).join(known, "document_id", "left_semi")
    users = (
        document_users(audit, directory, in_scope)
        .groupBy("document_id", "bu")
        .agg(F.max("controller").alias("controller"))
    )
    owners = owner_list(metadata, directory, in_scope, latest=False).drop("file_location").distinct()
    pairs = users.join(owners, "document_id", "left").select(
        "document_id",
        "document_name",
        F.col("full_path").alias("folder_path"),
        F.col("bu").alias("accessed_bu"),
        F.col("controller").alias("accessed_by_controller"),
        "scheduled",
        F.col("owner_bu").alias("ownedby_bu"),
        F.col("owner_is_manager").alias("ownedby_manager"),
        F.col("owner_is_controller").alias("ownedby_controller"),
    )
    return pairs.distinct().orderBy("document_id", "accessed_bu")


def units_detected(matrix: DataFrame) -> DataFrame:
    """Units on either side of the matrix; the unknown (null) unit is one of them."""
    sides = matrix.select(F.col("accessed_bu").alias("unit")).union(matrix.select("ownedby_bu"))
    return sides.distinct()


def consumer_profile(matrix: DataFrame) -> DataFrame:
    """One row per document: owner, consumers by unit, and usage flags.

    ``consumers`` has at most one entry per unit of the directory, which bounds the list.
    Rows of an unknown unit are no consumers. Attributes that differ between rows are
    taken from the first by unit area, unit, unknown last.
    """
    place = [F.col("accessed_bu_group"), F.col("accessed_bu")]
    order = F.struct(*(x for p in place for x in (p.isNull(), p)))
    known = F.col("accessed_bu").isNotNull()
    consumer = F.struct(
        F.col("accessed_bu_group").alias("unit_area"),
        F.col("accessed_bu").alias("unit"),
        F.col("accessed_users").alias("users"),
    )
    first = F.min_by(
        F.struct(
            "document_name",
            "folder_path",
            "csv_file_location",
            "scheduled",
            "ownedby_bu",
            "ownedby_bu_group",
            "ownedby_controller",
            "ownedby_manager",
            "accessed_by_controller",
        ),
        order,
    )
    grouped = matrix.groupBy("document_id").agg(
        first.alias("f"),
        F.count("*").alias("rows"),
        F.count_if(known).alias("consumer_units"),
        F.coalesce(F.sum(F.when(known, F.col("accessed_users"))), F.lit(0)).alias("consumer_users"),
        F.sort_array(F.collect_list(F.when(known, consumer))).alias("consumers"),
    )
    own_unit = (
        (F.col("consumer_units") == 1)
        & F.col("f.ownedby_bu").isNotNull()
        & (F.col("f.ownedby_bu") == F.get("consumers", F.lit(0))["unit"])
    )
    limited = F.coalesce(own_unit, F.lit(False))
    return grouped.select(
        "document_id",
        F.col("f.document_name").alias("document_name"),
        F.col("f.folder_path").alias("folder_path"),
        F.col("f.csv_file_location").alias("csv_file_location"),
        F.col("f.scheduled").alias("scheduled"),
        F.col("f.ownedby_bu").alias("owner_unit"),
        F.col("f.ownedby_bu_group").alias("owner_unit_area"),
        F.col("f.ownedby_controller").alias("owner_is_controller"),
        F.col("f.ownedby_manager").alias("owner_is_manager"),
        F.col("f.accessed_by_controller").alias("consumed_by_controllers"),
        "rows",
        "consumer_units",
        "consumer_users",
        "consumers",
        limited.alias("limited_to_owner_unit"),
        (limited & (F.col("consumer_users") == 1)).alias("personal_usage"),
    )
