"""Silver tables: users, universes, audit, file metadata, impact, freshness, ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportarium.functions import conditions as c
from reportarium.functions.times import from_parts, parsed, run_stamp
from reportarium.operators.keys import evenly, first_per_key, latest_per_key

# The catalogue's report type and the release date of the impact list.
REPORT_TYPE = "Webi"
RELEASE_DATE = "2026-12-31"
RISK, SAFE = "Risk_Universe", "Safe"


def user_profile(
    current: DataFrame,
    old: DataFrame,
    roles: DataFrame,
    run_date: str,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Current users completed by their latest old record and their seniority.

    Users without an old record are left out, unless ``keep_unmatched``.
    """
    previous = latest_per_key(old, ["user_name"], "ingestion_ts").select(
        "user_name",
        F.col("business_unit").alias("o_bu"),
        F.col("display_name").alias("o_display_name"),
        F.col("email_address").alias("o_email_address"),
    )
    levels = first_per_key(
        roles.select(F.col("title").alias("r_title"), "senior_level").filter("r_title is not null"),
        ["r_title"],
        [F.col("senior_level").asc_nulls_last()],
    )
    joined = current.join(previous, "user_name", "left" if keep_unmatched else "inner").join(
        evenly(levels), F.col("title") == F.col("r_title"), "left"
    )
    return joined.select(
        "user_name",
        c.current_or_old(F.col("display_name"), F.col("o_display_name")).alias("display_name"),
        c.clean_title(F.col("title")).alias("title"),
        c.seniority(F.col("senior_level")).alias("senior_level"),
        c.clean_unit(F.col("bu"), F.col("o_bu")).alias("bu"),
        c.clean_old_unit(F.col("o_bu")).alias("bu_old"),
        c.current_or_old(F.col("email_address"), F.col("o_email_address")).alias("email_address"),
        "country",
        run_stamp(run_date).alias("ingestion_ts"),
    )


def unit_changes(profile: DataFrame) -> DataFrame:
    """Users whose unit differs from the old one; an unknown unit on either side is no change."""
    return profile.filter(F.col("bu") != F.col("bu_old"))


def catalogue_entries(catalogue: DataFrame, report_type: str = REPORT_TYPE) -> DataFrame:
    """Distinct catalogue entries of one report type."""
    return (
        catalogue.filter(F.col("report_type") == report_type)
        .select("report_id", "report_cuid", "report_instance", "report_name")
        .distinct()
    )


def universe_profile(
    links: DataFrame, catalogue: DataFrame, run_date: str, report_type: str = REPORT_TYPE
) -> DataFrame:
    """Universe to document links with the document's catalogue entry, if any."""
    distinct = links.select("universe_id", "universe_name", "db_alias", "document_id").distinct()
    entries = catalogue_entries(catalogue, report_type)
    return distinct.join(entries, distinct.document_id == entries.report_id, "left").select(
        "universe_id",
        "universe_name",
        "db_alias",
        "document_id",
        "report_cuid",
        "report_name",
        "report_instance",
        run_stamp(run_date).alias("ingestion_ts"),
    )


def universe_unmatched(
    links: DataFrame, catalogue: DataFrame, report_type: str = REPORT_TYPE
) -> DataFrame:
    """Links whose document has no catalogue entry."""
    entries = catalogue_entries(catalogue, report_type).filter("report_cuid is not null")
    distinct = links.select("universe_id", "universe_name", "db_alias", "document_id").distinct()
    return distinct.join(entries, distinct.document_id == entries.report_id, "left_anti")


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(name))


def access_audit(
    raw: DataFrame, catalogue: DataFrame, report_type: str = REPORT_TYPE
) -> DataFrame:
    """Audit rows with a timestamp built from their parts and the report they concern."""
    entries = catalogue_entries(catalogue, report_type).select(
        F.col("report_id").alias("document_id"),
        F.col("report_name").alias("document_name"),
        "report_cuid",
    )
    return raw.join(entries, raw.object_id == entries.report_cuid, "left").select(
        "document_id",
        "document_name",
        F.col("object").alias("audit_name"),
        F.col("object_id").alias("audit_id"),
        "event_type",
        F.col("user").alias("user_name"),
        from_parts(F.col("year"), F.col("month"), F.col("day"), F.col("hour")).alias("access_ts"),
        "events",
    )


def impact_list(impact: DataFrame, release_date: str = RELEASE_DATE) -> DataFrame:
    return impact.select(
        "table_name",
        F.col("impacted").alias("wave_impacted"),
        "used_in_mi",
        F.lit(release_date).alias("release_date"),
    )


def impacted_universes(universes: DataFrame, impact: DataFrame) -> DataFrame:
    """Universes with the impacted tables they use, tagged ``Risk_Universe`` or ``Safe``."""
    name = lambda col: F.lower(F.trim(col))
    listed = impact.select(name(F.col("table_name")).alias("table_name"))
    used = universes.select("universe", F.explode_outer(F.split("tables", ",")).alias("t")).select(
        "universe", name(F.col("t")).alias("table_name")
    )
    # A universe without a match stays as a row without a table.
    hits = used.join(evenly(listed.distinct().withColumn("hit", F.lit(True))), "table_name", "left")
    hit = hits.select("universe", F.when(F.col("hit"), F.col("table_name")).alias("table_name"))
    return (
        hit.distinct()
        .groupBy("universe")
        .agg(F.sort_array(F.collect_list("table_name")).alias("matched_tables"))
        .withColumn("risk_tag", F.when(F.size("matched_tables") > 0, RISK).otherwise(SAFE))
    )


_FILE_COLUMNS = (
    "document_id",
    "document_cuid",
    "document_name",
    "folder_id",
    "full_path",
    "updated",
    "scheduled",
    "created_by",
    "last_author",
)


def file_metadata(
    catalogue: DataFrame,
    current: DataFrame,
    previous: DataFrame,
    report_type: str = REPORT_TYPE,
) -> DataFrame:
    """Catalogue entries (no instances) with file metadata of either generation."""
    files = (
        current.select(*_FILE_COLUMNS)
        .union(previous.select(*_FILE_COLUMNS))
        .filter("folder_id is not null")
        .distinct()
    )
    reports = catalogue.filter(
        (F.col("report_type") == report_type) & (F.col("report_instance") == F.lit(False))
    )
    return (
        reports.join(files, reports.report_id == files.document_id)
        .select(
            "report_id",
            "report_cuid",
            "report_name",
            "report_type",
            "user_login",
            "user_full_name",
            "document_id",
            "folder_id",
            "full_path",
            "updated",
            "scheduled",
            "created_by",
            F.col("last_author").alias("updated_by"),
        )
        .distinct()
    )


# Columns of the provider list, in its order.
_LISTED = (
    "document_id",
    "document_cuid",
    "document_name",
    "folder_id",
    "full_path",
    "scheduled",
    "updated",
    "number_of_data_providers",
    "data_provider_id",
    "data_provider_name",
    "data_source_id",
    "data_source_cuid",
    "refresh_time",
    "connection_id",
    "connection_name",
    "created_by",
    "last_author",
)


def provider_list(bronze: DataFrame) -> DataFrame:
    """Distinct providers of documents, without their statements."""
    return bronze.select(*_LISTED).distinct().withColumnRenamed("last_author", "updated_by")


def freshness_counts(providers: DataFrame) -> DataFrame:
    """Documents updated after, before, or without a refresh of their data; one row.

    Flags are raised per document first, so one small row per document travels instead
    of five copies of every provider row. Unreadable times count as missing.
    """
    updated, refreshed = parsed(F.col("updated")), parsed(F.col("refresh_time"))
    flags = {
        "count_updated_later": updated > refreshed,
        "count_updated_earlier": updated < refreshed,
        "no_refresh_time": refreshed.isNull(),
        "no_update_time": updated.isNull(),
    }
    per_document = (
        providers.filter("document_id is not null")
        .groupBy("document_id")
        .agg(*(c.any_true(flag).alias(name) for name, flag in flags.items()))
    )
    return per_document.agg(
        *(F.count_if(F.col(name)).alias(name) for name in flags), F.count("*").alias("total")
    )


def ingest_health(metadata: DataFrame, whole_months: bool = False) -> DataFrame:
    """Documents by month of ingestion and scheduling.

    The month is its number, so equal months of different years fall together;
    ``whole_months`` keeps years apart.
    """
    month = F.date_trunc("month", "ingestion_ts").cast("date") if whole_months else F.month("ingestion_ts")
    return metadata.groupBy(month.alias("ingestion_month"), "scheduled").agg(
        F.countDistinct("document_id").alias("documents")
    )


def column_fill(df: DataFrame) -> DataFrame:
    """Rows, and values that are not null in every column; one row."""
    return df.agg(F.count("*").alias("row_count"), *(F.count(F.col(x)).alias(x) for x in df.columns))
