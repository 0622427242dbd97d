"""The synthetic tables in the roles of the estate's tables.

Orders are report documents, line items their data providers and fields, customers the
users, nations and regions the units and unit areas, events the access audit and call
log, document texts the report outputs. Nulls, padding and markers the real feeds have
are made by rule from existing columns, for whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportarium.operators.lists import record_lists
from reportarium.operators.tagger import KEYWORDS

RUN_DATE = "2026-01-31"


# Columns of the given tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """Lazy readers of the table files in one folder; declared schemas need no job to be read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def prefixed(prefix: str, value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit(prefix), value.cast("string"))


def unit_names(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


def directory(t: Tables) -> DataFrame:
    """Users with unit and area; one nation's users have no unit."""
    return t.customer.join(unit_names(t), F.col("c_nationkey") == F.col("n_nationkey")).select(
        prefixed("u", "c_custkey").alias("user_id"),
        F.when(F.col("n_name") != "NATION_0", F.col("n_name")).alias("bu"),
        F.col("r_name").alias("bu_group"),
        (F.col("c_mktsegment") == "MACHINERY").alias("is_controller"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_manager"),
    )


def accessed_document() -> Column:
    """Half of the events hit fifty popular documents, the others are spread."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return F.when(k < 50, k).otherwise(F.expr("event_id div 4")).cast("string")


def event_name() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "purchase", "Edit")
        .when(kind == "signup", "Save")
        .when(kind == "click", "View")
        .when(kind == "view", "Refresh")
    )


def audit(t: Tables) -> DataFrame:
    """Accesses; user names vary in case and padding, some are missing."""
    user = (
        F.when(F.col("value") > 200, None)
        .when(F.col("event_type") == "signup", prefixed(" u", "user_id"))
        .otherwise(prefixed("U", "user_id"))
    )
    return t.events.select(
        accessed_document().alias("document_id"),
        user.alias("user_name"),
        event_name().alias("event_type"),
        F.col("ts").alias("access_ts"),
    )


def raw_audit(t: Tables) -> DataFrame:
    """Accesses with calendar parts; some have a thirteenth month."""
    document = accessed_document()
    return t.events.select(
        F.concat(F.lit("Report "), document).alias("object"),
        F.concat(F.lit("c"), document).alias("object_id"),
        event_name().alias("event_type"),
        prefixed("u", "user_id").alias("user"),
        F.year("ts").alias("year"),
        F.when(F.col("value") > 200, 13).otherwise(F.month("ts")).alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
        F.lit(1).cast("bigint").alias("events"),
    )


def scope(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus <> 'F'").select(text("o_orderkey").alias("document_id"))


def _created_by(user: Column) -> Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", None)
        .when(priority == "5-LOW", " administrator ")
        .otherwise(prefixed("u", user))
    )


def _location() -> Column:
    path = F.concat(F.lit("file:/exports/"), text("o_orderkey"), F.lit(".csv"))
    return F.when(F.col("o_orderstatus") != "O", path)


def _last_author() -> Column:
    return F.concat(F.lit("U"), F.expr("o_orderkey div 10").cast("string"))


def _folder() -> Column:
    return F.when(F.col("o_orderpriority") != "3-MEDIUM", prefixed("f", "o_custkey"))


def first_generation(t: Tables) -> DataFrame:
    return t.orders.select(
        text("o_orderkey").alias("document_id"),
        prefixed("c", "o_orderkey").alias("document_cuid"),
        prefixed("Report ", "o_orderkey").alias("document_name"),
        _folder().alias("folder_id"),
        F.concat(F.lit("/"), F.col("o_orderpriority")).alias("full_path"),
        _created_by(F.col("o_custkey")).alias("created_by"),
        _last_author().alias("last_author"),
        (F.col("o_orderstatus") == "O").alias("scheduled"),
        text("o_orderdate").alias("updated"),
        _location().alias("file_location"),
        F.col("o_orderdate").alias("ingestion_ts"),
    )


def second_generation(t: Tables) -> DataFrame:
    """Later records: pending orders under a new name and owner, open ones unchanged."""
    renamed = F.col("o_orderstatus") == "P"
    later = F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")
    name = prefixed("Report ", "o_orderkey")
    return t.orders.filter("o_orderstatus <> 'F'").select(
        text("o_orderkey").alias("document_id"),
        prefixed("c", "o_orderkey").alias("document_cuid"),
        F.when(renamed, F.concat(name, F.lit(" v2"))).otherwise(name).alias("document_name"),
        _folder().alias("folder_id"),
        F.concat(F.lit("/"), F.col("o_orderpriority")).alias("full_path"),
        F.when(renamed, _created_by(F.expr("o_custkey div 2")))
        .otherwise(_created_by(F.col("o_custkey")))
        .alias("created_by"),
        _last_author().alias("last_author"),
        F.lit(True).alias("scheduled"),
        text("o_orderdate").alias("updated"),
        _location().alias("file_location"),
        later.alias("ingestion_ts"),
    )


def snapshots(t: Tables) -> DataFrame:
    """Metadata snapshots: one or two per document."""
    return first_generation(t).union(second_generation(t))


def catalogue(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        text("o_orderkey").alias("report_id"),
        prefixed("c", "o_orderkey").alias("report_cuid"),
        prefixed("Report ", "o_orderkey").alias("report_name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Pdf").otherwise("Webi").alias("report_type"),
        (F.col("o_orderstatus") == "F").alias("report_instance"),
        prefixed("u", "o_custkey").alias("user_login"),
        F.col("c_name").alias("user_full_name"),
    )


def current_users(t: Tables) -> DataFrame:
    joined = t.customer.join(unit_names(t), F.col("c_nationkey") == F.col("n_nationkey"))
    poor = F.col("c_acctbal") < 0
    missing = F.lit("Does not exist")
    return joined.select(
        prefixed("u", "c_custkey").alias("user_name"),
        F.when(poor, missing).otherwise(F.col("c_name")).alias("display_name"),
        F.when(F.col("c_mktsegment") == "FURNITURE", missing)
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Not applicable")
        .otherwise(F.col("c_mktsegment"))
        .alias("title"),
        F.when(F.col("n_nationkey") < 5, missing).otherwise(F.col("n_name")).alias("bu"),
        F.when(poor, missing)
        .otherwise(F.concat(prefixed("u", "c_custkey"), F.lit("@example.com")))
        .alias("email_address"),
        F.col("r_name").alias("country"),
    )


def old_users(t: Tables) -> DataFrame:
    """Old records from finished orders: none, one or several per user."""
    priority = F.col("o_orderpriority")
    missing = F.lit("Does not exist")
    return t.orders.filter("o_orderstatus = 'F'").select(
        prefixed("u", "o_custkey").alias("user_name"),
        F.when(priority == "1-URGENT", None)
        .when(priority == "2-HIGH", missing)
        .when(priority == "3-MEDIUM", "Unidentified")
        .otherwise(F.concat(F.lit("NATION_"), F.expr("o_orderkey % 25").cast("string")))
        .alias("business_unit"),
        F.when(priority == "4-NOT SPECIFIED", missing)
        .otherwise(prefixed("Old ", "o_custkey"))
        .alias("display_name"),
        F.when(priority == "5-LOW", missing)
        .otherwise(F.concat(prefixed("old", "o_custkey"), F.lit("@example.com")))
        .alias("email_address"),
        F.col("o_orderdate").alias("ingestion_ts"),
    )


def role_levels(t: Tables) -> DataFrame:
    """Title to level; one title has two levels."""
    boss = (F.col("c_mktsegment") == "BUILDING") | (
        (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_nationkey") > 12)
    )
    return t.customer.select(
        F.col("c_mktsegment").alias("title"),
        F.when(boss, "Manager").otherwise("Staff").alias("senior_level"),
    ).distinct()


def universe_links(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        prefixed("p", "l_partkey").alias("universe_id"),
        F.col("p_name").alias("universe_name"),
        F.col("p_brand").alias("db_alias"),
        text("l_orderkey").alias("document_id"),
    )


def _part_table() -> Column:
    return F.concat(F.col("p_brand"), F.lit("-"), text("p_size"))


def universe_tables(t: Tables) -> DataFrame:
    """Comma lists of tables per universe, with spaces and a trailing comma."""
    listed = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(",")), F.lit(", "), _part_table(), F.lit(","))
    return t.part.select(
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_name")).alias("universe"),
        F.when(F.col("p_retailprice") > 901, listed).alias("tables"),
    )


def impact(t: Tables, promoted: bool = False) -> DataFrame:
    """Tables of a migration: those of all parts, or of promoted parts only."""
    return t.part.filter("p_type = 'PROMO'" if promoted else "true").select(
        F.concat(F.lit(" "), F.upper(_part_table())).alias("table_name"),
        F.lit("yes").alias("impacted"),
        F.when(F.col("p_size") > 25, "no").otherwise("yes").alias("used_in_mi"),
    )


def provider_times(t: Tables) -> DataFrame:
    """Providers with the times of their document and data as text, partly unreadable."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        text("l_orderkey").alias("document_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "unknown")
        .otherwise(text("o_orderdate"))
        .alias("updated"),
        F.when(F.col("l_returnflag") == "R", None)
        .when(F.col("l_linenumber") == 7, "never")
        .otherwise(text("l_shipdate"))
        .alias("refresh_time"),
    )


def document_facts(t: Tables) -> DataFrame:
    """Documents with extraction statistics, as text like in the landed files.

    Customers stand for drafts: documents of theirs without any provider.
    """
    drafts = t.customer.select(
        prefixed("draft ", "c_custkey").alias("document_id"),
        F.col("c_name").alias("document_name"),
        F.lit("False").alias("extraction_stats"),
    )
    return _stored_facts(t).unionByName(drafts, allowMissingColumns=True)


def _stored_facts(t: Tables) -> DataFrame:
    return first_generation(t).select(
        "document_id",
        "document_cuid",
        "document_name",
        "folder_id",
        "full_path",
        "created_by",
        "last_author",
        "scheduled",
        "updated",
        F.lit("True").alias("extraction_stats"),
        F.lit("3").alias("number_of_api_calls"),
    )


def document_providers(t: Tables) -> DataFrame:
    """Providers of documents: all line items."""
    return t.lineitem.select(text("l_orderkey").alias("document_id"), *_provider_texts())


def _provider_texts() -> list[Column]:
    sql = F.concat(F.lit('SELECT "q"\nFROM t\nWHERE n = '), text("l_linenumber"))
    return [
        _provider_id().alias("data_provider_id"),
        prefixed("p", "l_partkey").alias("data_source_id"),
        text("l_shipdate").alias("refresh_time"),
        F.lit("1").alias("sql_index"),
        sql.alias("sql_query"),
        prefixed("s", "l_suppkey").alias("connection_id"),
        F.lit("db").alias("connection_database"),
    ]


def documented_providers(t: Tables) -> DataFrame:
    """Providers with the facts of their document; the texts of a line are made behind the join."""
    facts = document_facts(t).drop("extraction_stats", "number_of_api_calls")
    numbers = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    lines = t.lineitem.select(text("l_orderkey").alias("document_id"), *numbers)
    kept = [c for c in facts.columns if c != "document_id"]
    return lines.join(facts, "document_id").select("document_id", *_provider_texts(), *kept)


def response_providers(t: Tables) -> DataFrame:
    """Line items as providers met by the service: one row per provider."""
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()


def _of(row: Column | None, name: str) -> Column:
    return F.col(name) if row is None else row[name]


def _provider_id(row: Column | None = None) -> Column:
    numbers = (_of(row, name).cast("string") for name in ("l_linenumber", "l_partkey", "l_suppkey"))
    return F.concat_ws("-", F.lit("DP"), *numbers)


def _source_type(row: Column | None = None) -> Column:
    line = _of(row, "l_linenumber")
    return (
        F.when(line == 6, "fhsql")
        .when(line == 7, "excel")
        .when(line.isin(2, 5), "unx")
        .otherwise("unv")
    )


def responses(t: Tables) -> DataFrame:
    """Landed responses as rows ``path, body``, as many as the providers ask for."""

    def path(document: Column, *rest) -> Column:
        parts = [r if isinstance(r, Column) else F.lit(r) for r in rest]
        return F.concat(F.lit("API_Response_For_"), document, F.lit("/"), document, *parts)

    def pair(index: Column, sql: Column) -> Column:
        return F.struct(index.alias("@index"), sql.alias("$"))

    details = t.orders.select(
        path(text("o_orderkey"), "_Details.json").alias("path"),
        F.to_json(
            F.struct(
                F.struct(
                    F.col("o_orderkey").alias("id"),
                    prefixed("c", "o_orderkey").alias("cuid"),
                    F.col("o_custkey").alias("folderId"),
                    F.col("o_orderpriority").alias("path"),
                    prefixed("Report ", "o_orderkey").alias("name"),
                    text("o_orderdate").alias("updated"),
                    (F.col("o_orderstatus") == "O").alias("scheduled"),
                    prefixed("u", "o_custkey").alias("createdBy"),
                    _last_author().alias("lastAuthor"),
                ).alias("document")
            )
        ).alias("body"),
    )
    met = response_providers(t)
    # Lists are made of the numbers, and their texts in the row of the document.
    by_document = record_lists(
        met, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "lines"
    )
    entry = lambda row: F.struct(
        _provider_id(row).alias("id"),
        prefixed("Query ", row["l_linenumber"]).alias("name"),
        prefixed("p", row["l_partkey"]).alias("dataSourceId"),
        _source_type(row).alias("dataSourceType"),
    )
    listed = F.sort_array(F.transform("lines", entry)).alias("dataprovider")
    lists = by_document.select(
        path(text("l_orderkey"), "_dataproviders_Response.json").alias("path"),
        F.to_json(F.struct(F.struct(listed).alias("dataproviders"))).alias("body"),
    )
    sql = F.concat(F.lit("SELECT * FROM t"), text("l_partkey"))
    prop = F.struct(F.lit("sql").alias("@key"), sql.alias("$"))
    detail = F.struct(
        path(text("l_orderkey"), "_", _provider_id(), "_Response.json").alias("path"),
        F.to_json(
            F.struct(
                F.struct(
                    _source_type().alias("dataSourceType"),
                    prefixed("Source ", "l_partkey").alias("dataSourceName"),
                    F.when(F.col("l_linenumber") == 6, F.struct(F.array(prop).alias("property"))).alias(
                        "properties"
                    ),
                ).alias("dataprovider")
            )
        ).alias("body"),
    )
    one = pair(F.lit("1"), sql)
    two = pair(F.lit("2"), F.concat(sql, F.lit("\nUNION")))
    line = F.col("l_linenumber")
    # Plans of three, five and fifty levels.
    part = F.col("l_partkey")
    wraps = F.when(part % 10 == 1, 2).when(part % 100 == 2, 47).otherwise(0)
    union = F.array(F.struct(F.array(one, two).alias("statement"))).alias("union")
    inner = F.to_json(F.struct(F.struct(union).alias("plan")))
    nested = F.concat(F.repeat(F.lit('{"part": '), wraps), inner, F.repeat(F.lit("}"), wraps))
    plan = (
        F.when(line == 1, F.to_json(F.struct(one.alias("statement"))))
        .when(line == 2, F.to_json(F.struct(F.array(one, two).alias("statement"))))
        .when(line == 3, nested)
        .when(line == 4, "{}")
        .when(line == 5, '{"status": "empty"}')
    )
    plans = F.struct(
        path(text("l_orderkey"), "_", _provider_id(), "_queryplan_Response.json").alias("path"),
        F.concat(F.lit('{"queryplan": '), plan, F.lit("}")).alias("body"),
    )
    # Both responses of a provider come from its one row.
    both = F.array_compact(F.array(detail, F.when(line <= 5, plans)))
    of_providers = met.select(F.explode(both).alias("r")).select("r.path", "r.body")
    size = text("p_size")
    connections = t.part.select("p_size").distinct().select(
        path(F.lit("0"), "_", size, "_Response.json").alias("path"),
        F.to_json(
            F.struct(
                F.struct(
                    F.lit("Relational").alias("@type"),
                    size.alias("id"),
                    prefixed("Connection ", "p_size").alias("name"),
                    prefixed("db", "p_size").alias("database"),
                    F.lit("odbc").alias("networkLayer"),
                ).alias("connection")
            )
        ).alias("body"),
    )
    return details.union(lists).union(of_providers).union(connections)


def universe_connections(t: Tables) -> DataFrame:
    """Universe to connection; promotion parts are not in the list."""
    return t.part.filter("p_type <> 'PROMO'").select(
        prefixed("p", "p_partkey").alias("universe_id"), text("p_size").alias("connection_id")
    )


def calls(t: Tables) -> DataFrame:
    """Service calls; an event's value is its duration."""
    micros = F.round(F.col("value") * 20_000).cast("bigint")
    return t.events.select(
        accessed_document().alias("document_id"),
        F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status"),
        F.col("ts").alias("started"),
        F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("ended"),
    )


def work_list(t: Tables) -> DataFrame:
    lang = F.col("lang")
    return t.documents.select(
        text("doc_id").alias("report_id"),
        F.when(lang == "fr", " true ").when(lang == "de", None).otherwise("FALSE").alias("extracted_status"),
        F.when(lang == "fr", "2025-12-31").alias("extracted_date"),
    )


#: All phrases of the keyword table, in its order.
PHRASES = tuple(phrase for listed in KEYWORDS.values() for phrase in listed)


def phrased(t: Tables) -> DataFrame:
    """Documents with phrases of the keyword table in a title, where they have one, and a text.

    A phrase in the text may run into another one, or lack its last word.
    """
    known = F.array(*map(F.lit, PHRASES))

    def phrase(number: Column) -> Column:
        return F.get(known, F.pmod(number, F.lit(len(PHRASES))).cast("int"))

    number = F.col("doc_id")
    cut = F.regexp_replace(phrase(number * 3 + 5), "[a-z]+$", "")
    word = F.substring_index("text", " ", 1)
    title = F.concat_ws(" - ", word, F.upper(phrase(number * 7 + F.char_length("text"))))
    return t.documents.select(
        "doc_id",
        F.when(number % 3 == 0, title).alias("report_title"),
        F.concat_ws(" ", phrase(number), phrase(number * 11 + 1), F.lit("/"), cut, word).alias(
            "additional_metadata"
        ),
    )


def processed(t: Tables) -> DataFrame:
    return t.labels.select(
        text("doc_id").alias("report_id"),
        F.when(F.col("quality") == 1, "True").otherwise("FALSE").alias("extracted_status"),
        F.lit(RUN_DATE).alias("extracted_date"),
    )


def labelled_details(t: Tables) -> DataFrame:
    """Details the service gave: those of the documents that have a label."""
    return t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi").select(
        text("doc_id").alias("document_id"),
        prefixed("c", "doc_id").alias("document_cuid"),
        prefixed("Report ", "doc_id").alias("document_name"),
        F.col("source").alias("folder_id"),
        F.col("lang").alias("scheduled"),
    )


def outputs(t: Tables, tabs: bool = False) -> DataFrame:
    """Report outputs; with ``tabs`` words are cells."""
    body = F.col("text")
    if tabs:
        body = F.replace(body, F.lit(" "), F.lit("\t"))
    return t.documents.select(text("doc_id").alias("document_id"), body.alias("text"))


def entries(t: Tables) -> DataFrame:
    """Field definitions: line items with what their part says; several parts are null."""
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        text("l_orderkey").alias("document_id"),
        F.when(F.col("l_linestatus") == "O", "dimension").otherwise("measure").alias("entry_type"),
        F.col("p_name").alias("entry_name"),
        F.col("p_type").alias("entry_datatype"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("entry_qualification"),
        F.lit(None).cast("string").alias("extracted_datafield"),
        F.col("p_brand").alias("universe_name"),
        F.lit(None).cast("string").alias("datafield_datasourcepath"),
        F.lit(None).cast("string").alias("datafield_description"),
        F.lit(None).cast("string").alias("sql_definition"),
        F.lit(None).cast("string").alias("variable_definition"),
        F.lit(None).cast("string").alias("datafield_name_universe"),
    )


def answers(t: Tables) -> DataFrame:
    """Answers of a classifier; a toxic document's answer is not JSON."""
    lang = F.col("lang")
    good = F.col("quality") == 1
    entities = F.when(lang == "en", F.array(F.lit("Policy"), F.lit("Claim"))).otherwise(
        F.array(F.lit("Policy"), lang)
    )
    body = F.to_json(
        F.struct(
            F.concat(F.lit("Report "), text("doc_id")).alias("report_name_in_english"),
            F.col("text").alias("report_description"),
            entities.alias("monitored_entities"),
            F.array("source").alias("classification_evidence"),
            F.when(good, "Management").otherwise("Strategic").alias("report_purpose"),
            F.when(F.col("n_chars") > 1000, F.col("text")).otherwise(lang).alias("report_purpose_description"),
            F.when(lang == "en", "Domestic").when(lang == "fr", "Cross-Border").when(lang == "es", "Local").alias("geo_scope"),
            F.lit("Where it is used.").alias("geo_scope_description"),
            F.lit("Buyer").alias("entity_subject"),
            F.lit("Whom it is about.").alias("entity_subject_description"),
            F.when(good, "high").otherwise("certain").alias("confidence"),
        )
    )
    return t.documents.join(t.labels, "doc_id", "left").select(
        text("doc_id").alias("document_id"),
        F.when(F.col("toxic") == 1, F.col("text")).otherwise(body).alias("answer"),
    )


def model_responses(t: Tables) -> DataFrame:
    """Responses with nested usage numbers; characters stand in for tokens."""
    usage = F.struct(
        F.char_length("text").alias("prompt_tokens"),
        F.col("turn").alias("completion_tokens"),
        (F.char_length("text") + F.col("turn")).alias("total_tokens"),
    )
    return t.conversations.select(
        F.to_json(
            F.struct(
                F.concat_ws("-", text("conv_id"), text("turn")).alias("id"),
                F.concat(F.lit("model-"), F.col("role")).alias("model"),
                usage.alias("usage"),
            )
        ).alias("body")
    )
