"""The registered queries: every plan of the estate over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportarium.functions.text import path_segment
from reportarium.operators.contract import check_answers, check_domain_answers, weakest
from reportarium.operators.chunks import chunk_text
from reportarium.operators.keys import latest_per_key
from reportarium.operators.tagger import tag_domain
from reportarium.operators.worklist import (
    read_work_list,
    rewrite_work_list,
    store_work_list,
    pending,
    unprocessed,
    update_work_list,
    with_placeholders,
)
from reportarium.plans import bronze, costs, enrich, exports, extraction, fields, silver, usage
from reportarium.schemas import DOMAIN_ANSWER
from reportarium.session import scratch_dir
from reportarium.sources.documents import read_texts
from reportarium.sources.exports import read_outputs
from reportarium.sources.output_files import read_heads, write_outputs
from reportarium.sources.sinks import (
    add_timestamp_column,
    append_by_name,
    append_json_lines,
    document_json,
    replace_table,
    with_timestamp_column,
    write_dated,
    write_document_lines,
    write_quoted_csv,
)
from reportarium.sources.tables import read_parquet, read_table, union_generations
from reportarium.streaming.bronze_stream import load_new_files
from reportarium.workload import roles
from reportarium.workload.roles import RUN_DATE, Tables

# Stand-in vocabulary: the texts are invented prose, so frequent words play the keywords.
VOCABULARY = {
    "Data Management": ("the", "of"),
    "Claims and Recovery Management": ("que", "la", "le"),
    "Contract Management": ("der", "die", "und"),
    "IT Management": ("tion", "ci"),
}
# Stand-in for the forbidden terms, for the same reason.
TERMS = ("universe", "the", "que", "und")
CHUNK = 1000


def listed(column: str) -> Column:
    """A list as one text, nulls as ``-``."""
    return F.array_join(column, ",", "-").alias(column)


def _matrix(t: Tables) -> DataFrame:
    return usage.usage_matrix(
        roles.snapshots(t), roles.audit(t), roles.directory(t), roles.scope(t)
    )


def usage_matrix(t: Tables) -> DataFrame:
    return _matrix(t)


def _consumers_text() -> Column:
    entry = F.transform(
        "consumers",
        lambda c: F.concat_ws(":", F.coalesce(c["unit_area"], F.lit("-")), c["unit"], c["users"].cast("string")),
    )
    return F.array_join(F.array_sort(entry), ",").alias("consumers")


def consumer_profile(t: Tables) -> DataFrame:
    profile = usage.consumer_profile(_matrix(t))
    return profile.select(*(c for c in profile.columns if c != "consumers"), _consumers_text())


def usage_pairs_v1(t: Tables) -> DataFrame:
    return usage.usage_pairs(
        roles.snapshots(t), roles.audit(t), roles.directory(t), roles.scope(t)
    )


def shortlist(t: Tables) -> DataFrame:
    return usage.shortlist(roles.scope(t), roles.audit(t))


def shortlist_first(t: Tables) -> DataFrame:
    """The first documents of the shortlist by id; the limit is the report's."""
    return usage.shortlist(roles.scope(t), roles.audit(t), limit=25)


def distinct_consumers(t: Tables) -> DataFrame:
    return usage.distinct_consumers(roles.scope(t), roles.audit(t))


def shortlist_audited(t: Tables) -> DataFrame:
    return usage.shortlist_profile(roles.scope(t), roles.audit(t), roles.directory(t))


def shortlist_share(t: Tables) -> DataFrame:
    return usage.shortlist_share(roles.scope(t), roles.audit(t))


def units_detected(t: Tables) -> DataFrame:
    return usage.units_detected(_matrix(t))


def usage_category_counts(t: Tables) -> DataFrame:
    return usage.category_counts(roles.audit(t))


def audit_by_unit(t: Tables) -> DataFrame:
    """Audit rows with category and profile, counted."""
    rows = usage.audit_with_category(roles.audit(t), roles.directory(t))
    return rows.groupBy("usage_category", "bu", "bu_group", "is_controller", "is_manager").agg(
        F.count("*").alias("events"), F.countDistinct("user_name").alias("users")
    )


def owner_list(t: Tables) -> DataFrame:
    return usage.owner_list(roles.snapshots(t), roles.directory(t), roles.scope(t))


def owner_states(t: Tables) -> DataFrame:
    """Owners of every recorded state of a document."""
    return usage.owner_list(roles.snapshots(t), roles.directory(t), roles.scope(t), latest=False)


def _profile(t: Tables, keep: bool = False) -> DataFrame:
    return silver.user_profile(
        roles.current_users(t), roles.old_users(t), roles.role_levels(t), RUN_DATE, keep
    )


def user_profile_clean(t: Tables) -> DataFrame:
    return _profile(t)


def user_profile_all(t: Tables) -> DataFrame:
    return _profile(t, keep=True)


def user_unit_changed(t: Tables) -> DataFrame:
    return silver.unit_changes(_profile(t))


def universe_profile(t: Tables) -> DataFrame:
    return silver.universe_profile(roles.universe_links(t), roles.catalogue(t), RUN_DATE)


def universe_unmatched(t: Tables) -> DataFrame:
    return silver.universe_unmatched(roles.universe_links(t), roles.catalogue(t))


def universe_count(t: Tables) -> DataFrame:
    return silver.distinct_count(universe_profile(t), "universe_id", "universes")


def access_audit(t: Tables) -> DataFrame:
    return silver.access_audit(roles.raw_audit(t), roles.catalogue(t))


def audited_objects(t: Tables) -> DataFrame:
    return silver.distinct_count(access_audit(t), "audit_id", "objects")


def impact_list(t: Tables) -> DataFrame:
    return silver.impact_list(roles.impact(t))


def impacted_universes(t: Tables) -> DataFrame:
    found = silver.impacted_universes(roles.universe_tables(t), roles.impact(t, promoted=True))
    return found.select("universe", listed("matched_tables"), "risk_tag")


def file_metadata(t: Tables) -> DataFrame:
    return silver.file_metadata(
        roles.catalogue(t), roles.first_generation(t), roles.second_generation(t)
    )


def freshness_counts(t: Tables) -> DataFrame:
    return silver.freshness_counts(roles.provider_times(t))


def ingest_health_month(t: Tables) -> DataFrame:
    return silver.ingest_health(roles.snapshots(t))


def ingest_health_whole_months(t: Tables) -> DataFrame:
    return silver.ingest_health(roles.snapshots(t), whole_months=True)


def column_fill(t: Tables) -> DataFrame:
    return silver.column_fill(with_timestamp_column(roles.snapshots(t), "checked_ts"))


def generations_by_name(t: Tables) -> DataFrame:
    """Two generations with different columns in one table, counted per path."""
    older = roles.first_generation(t).drop("scheduled", "file_location")
    both = union_generations(roles.second_generation(t), older)
    return both.groupBy("full_path", "scheduled").agg(
        F.count("*").alias("rows"), F.count("file_location").alias("located")
    )


def _landing(t: Tables) -> str:
    """Landed documents; some lists hold elements that are no providers."""
    path = scratch_dir(t.spark, "landing")
    landed = document_json(roles.document_facts(t), roles.document_providers(t))
    odd = F.replace(
        "value", F.lit('"Data_Providers":[{'), F.lit('"Data_Providers":["no provider",7,null,{')
    )
    value = F.when(F.crc32(F.col("document_id").cast("binary")) % 5 == 0, odd).otherwise(F.col("value"))
    write_document_lines(landed.withColumn("value", value), path)
    return path


_BRONZE = (
    "document_id",
    "document_cuid",
    "document_name",
    "folder_id",
    "created_by",
    "scheduled",
    "updated",
    "extraction_stats",
    "number_of_api_calls",
    "data_provider_id",
    "data_source_id",
    "refresh_time",
    "sql_index",
    "sql_query",
    "connection_id",
    "connection_name",
    "connection_database",
)


def bronze_flatten(t: Tables) -> DataFrame:
    landing, target = _landing(t), scratch_dir(t.spark, "bronze")
    texts = read_texts(t.spark, landing, one_per_file=False)
    bronze.load_batch(t.spark, texts, target, "first")
    bronze.load_batch(t.spark, texts, target, "again")  # everything known: adds nothing
    return bronze.read_bronze(t.spark, target).select(*_BRONZE)


def provider_list(t: Tables) -> DataFrame:
    target = scratch_dir(t.spark, "bronze")
    bronze.load_batch(t.spark, read_texts(t.spark, _landing(t), one_per_file=False), target, "first")
    return silver.provider_list(bronze.read_bronze(t.spark, target))


def bronze_stream_load(t: Tables) -> DataFrame:
    landing, target = _landing(t), scratch_dir(t.spark, "bronze")
    for _ in range(2):  # a second stream with a checkpoint of its own finds nothing new
        load_new_files(
            t.spark, landing, target, scratch_dir(t.spark, "checkpoint"), one_per_file=False
        )
    return bronze.read_bronze(t.spark, target).select(*_BRONZE)


def reference_list_load(t: Tables) -> DataFrame:
    raw, table = scratch_dir(t.spark, "list"), scratch_dir(t.spark, "table")
    source = t.supplier.select(
        F.col("s_suppkey").alias(" Supplier-Key"),
        F.col("s_name").alias("Name (legal)"),
        F.col("s_nationkey").alias("nation=key"),
        F.col("s_acctbal").cast("string").alias("Balance;{EUR}"),
        F.lit("x").alias("Unnamed: 3"),
    )
    write_quoted_csv(source, raw)
    write_dated(bronze.reference_list(t.spark, raw, RUN_DATE), table, RUN_DATE)
    loaded = read_parquet(t.spark, table)
    return loaded.withColumn("load_date", F.col("load_date").cast("string"))


def table_generations(t: Tables) -> DataFrame:
    """A catalog table that is replaced, appended to by name, widened, and read back."""
    database = f"estate_{uuid.uuid4().hex[:12]}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(t.spark, 'warehouse')}'")
    table = f"{database}.metadata"
    open_ones, others = F.col("o_orderstatus") == "O", F.col("o_orderstatus") != "O"
    replace_table(t.orders.filter(others).limit(1), table)
    replace_table(t.orders.filter(others).select("o_orderkey", "o_orderstatus", "o_totalprice"), table)
    append_by_name(t.orders.filter(open_ones).select("o_totalprice", "o_orderkey", "o_orderstatus"), table)
    add_timestamp_column(t.spark, table)
    dated = F.col("o_orderdate").cast("timestamp_ntz").alias("ingestion_ts")
    later = (F.col("o_orderkey") + 10**12).alias("o_orderkey")
    append_by_name(t.orders.filter(open_ones).select(dated, later, "o_orderstatus", "o_totalprice"), table)
    return read_table(t.spark, table).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ingestion_ts").alias("stamped"),
        F.max("ingestion_ts").cast("string").alias("last"),
        F.sum("o_orderkey").alias("keys"),
    )


def provider_sql_extract(t: Tables) -> DataFrame:
    landed = extraction.land_responses(roles.responses(t), scratch_dir(t.spark, "responses"))
    return extraction.provider_sql(landed, roles.universe_connections(t))


_EXTRACTED = (
    *("document_id", "document_cuid", "document_name", "folder_id", "full_path", "created_by"),
    *("last_author", "scheduled", "updated", "extraction_stats", "number_of_api_calls"),
    *("api_pause_counts", "number_of_data_providers", "data_provider_id", "data_provider_name"),
    *("data_source_id", "data_source_type", "data_source_name", "sql_index", "sql_query"),
    *("connection_id", "connection_name", "connection_type", "connection_database"),
    "connection_network",
)


def extraction_to_bronze(t: Tables) -> DataFrame:
    """Responses to providers and statistics, to landed documents, to bronze rows."""
    responses = extraction.land_responses(roles.responses(t), scratch_dir(t.spark, "responses"))
    found = extraction.provider_sql(responses, roles.universe_connections(t))
    providers = read_parquet(t.spark, _written(t, found))
    documents = extraction.extracted_documents(responses, providers, roles.calls(t))
    landing, target = scratch_dir(t.spark, "landing"), scratch_dir(t.spark, "bronze")
    write_document_lines(document_json(documents, providers), landing)
    texts = read_texts(t.spark, landing, one_per_file=False)
    bronze.load_batch(t.spark, texts, target, "first")
    return bronze.read_bronze(t.spark, target).select(*_EXTRACTED)


def _written(t: Tables, df: DataFrame) -> str:
    """A step's result in a folder of its own, for steps that read it more than once."""
    path = scratch_dir(t.spark, "step")
    df.write.parquet(path, compression="zstd")
    return path


def flat_extract(t: Tables) -> DataFrame:
    """Flat extract of the bronze providers in short pieces, written as CSV and read back."""
    rows = roles.documented_providers(t)
    provider, source = F.col("data_provider_id"), F.col("data_source_id")
    wide = rows.withColumns(
        {
            "data_provider_name": F.concat(F.lit("Query "), provider),
            "data_source_cuid": F.concat(F.lit("cuid-"), source),
            "data_source_type": F.lit("unv"),
            "data_source_name": F.concat(F.lit("Universe "), source),
            "connection_name": F.concat(F.lit("Connection "), F.col("connection_id")),
            "connection_type": F.lit("Relational"),
        }
    )
    path = scratch_dir(t.spark, "flat")
    write_quoted_csv(extraction.flat_extract(wide, "Reports", size=20), path)
    reader = t.spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.csv(path).fillna("")


def sql_chunks(t: Tables) -> DataFrame:
    source = t.documents.select("doc_id", F.lit("1").alias("sql_index"), F.col("text").alias("sql_query"))
    cut = chunk_text(source, "sql_query", "sql_index", CHUNK)
    return cut.select(
        "doc_id",
        "sql_index",
        "is_partial",
        F.char_length("sql_query").alias("chars"),
        F.md5("sql_query").alias("digest"),
    )


def extraction_stats(t: Tables) -> DataFrame:
    found = extraction.extraction_stats(roles.calls(t))
    return found.withColumn("execution_time_sec", F.round("execution_time_sec", 6))


def run_totals(t: Tables) -> DataFrame:
    return extraction.run_totals(roles.calls(t))


def call_outcomes(t: Tables) -> DataFrame:
    return extraction.found_flags(roles.calls(t))


def providers_per_document(t: Tables) -> DataFrame:
    return extraction.providers_per_document(
        roles.response_providers(t).withColumnRenamed("l_orderkey", "document_id")
    )


def worklist_update(t: Tables) -> DataFrame:
    return update_work_list(roles.work_list(t), roles.processed(t))


def worklist_rewrite(t: Tables) -> DataFrame:
    """A stored work list after the reports of one source were processed, read back."""
    path = scratch_dir(t.spark, "worklist")
    store_work_list(roles.work_list(t), path)
    of_source = t.documents.filter("source = 'src3'").select(F.col("doc_id").cast("string").alias("report_id"))
    rewrite_work_list(t.spark, path, roles.processed(t).join(of_source, "report_id", "left_semi"))
    return read_work_list(t.spark, path)


def worklist_placeholders(t: Tables) -> DataFrame:
    return with_placeholders(roles.work_list(t).select("report_id"), roles.labelled_details(t))


def registry_pending(t: Tables) -> DataFrame:
    """Listed reports not done and not in the registry."""
    todo = pending(roles.work_list(t)).withColumnRenamed("report_id", "document_id")
    registry = roles.processed(t).withColumnRenamed("report_id", "document_id")
    return unprocessed(todo, registry).select("document_id", "extracted_status")


def export_paths(t: Tables) -> DataFrame:
    ids = usage.shortlist(roles.scope(t), roles.audit(t)).withColumnRenamed(
        "shortlist_id", "document_id"
    )
    return exports.export_paths(ids, roles.snapshots(t))


def path_segments(t: Tables) -> DataFrame:
    """Last and second last segment of page addresses, counted."""
    parts = t.pages.select(
        path_segment(F.col("url")).alias("last_segment"),
        path_segment(F.col("url"), 2).alias("second_last_segment"),
    )
    return parts.groupBy("last_segment", "second_last_segment").agg(F.count("*").alias("pages"))


def _fields(t: Tables) -> DataFrame:
    return fields.field_dictionary(roles.entries(t), roles.scope(t))


def field_dictionary(t: Tables) -> DataFrame:
    found = _fields(t).withColumn("variables", fields.definition_json())
    return found.withColumn("variables", F.array_join(F.array_sort("variables"), ";"))


def _output_heads(t: Tables, texts: DataFrame) -> DataFrame:
    """Heads of outputs (document_id, text), written as one file each."""
    folder = scratch_dir(t.spark, "outputs")
    name = F.concat(F.lit("WEBI_"), "document_id", F.lit(".csv")).alias("name")
    write_outputs(texts.select(name, "text"), folder)
    return read_heads(t.spark, folder)


def output_sample_text(t: Tables) -> DataFrame:
    return exports.text_samples(_output_heads(t, roles.outputs(t)))


def output_sample_files(t: Tables) -> DataFrame:
    """Samples of text files: one file per benchmark item, read back as whole texts."""
    folder = scratch_dir(t.spark, "outputs")
    items = t.benchmark.select(F.concat(F.lit("Item_"), "item_id").alias("name"), "text")
    write_outputs(items, folder)
    return exports.text_samples(read_outputs(t.spark, f"{folder}/batch-*/task-*/*"))


def output_sample_columns(t: Tables) -> DataFrame:
    sampled = exports.column_samples(_output_heads(t, roles.outputs(t, tabs=True)))
    cells = sampled.select("document_id", "sample_text", F.explode_outer("columns").alias("c"))
    return cells.select(
        "document_id",
        F.col("c.name").alias("name"),
        F.array_join("c.values", "|", "-").alias("values"),
        "sample_text",
    )


def output_blocks(t: Tables) -> DataFrame:
    texts = roles.outputs(t, tabs=True).withColumn(
        "text", F.replace("text", F.lit(".\n"), F.lit("\n\n"))
    )
    blocks = exports.output_blocks(texts)
    return blocks.withColumn("rows", F.array_join("rows", "\n"))


def output_blocks_compat(t: Tables) -> DataFrame:
    texts = roles.outputs(t, tabs=True).withColumn(
        "text", F.replace("text", F.lit(".\n"), F.lit("\n\n"))
    )
    blocks = exports.output_blocks(texts, compat=True)
    return blocks.withColumn("rows", F.array_join("rows", "\n"))


def _enriched(t: Tables) -> DataFrame:
    profile = usage.consumer_profile(_matrix(t))
    return enrich.enriched_documents(profile, _fields(t), exports.text_samples(roles.outputs(t)))


def enriched_documents(t: Tables) -> DataFrame:
    return _enriched(t).select(
        "document_id",
        "document_name",
        "owner_unit",
        "consumer_units",
        "consumer_users",
        F.col("fields.variables_count").alias("variables_count"),
        F.md5("sample").alias("sample_digest"),
    )


def document_requests(t: Tables) -> DataFrame:
    """Requests of enriched documents, read back for what they hold."""
    requests = enrich.document_requests(_enriched(t))
    user = F.get_json_object("request", "$.messages[1].content")
    return requests.select(
        "document_id",
        F.get_json_object(user, "$.document_name").alias("document_name"),
        F.get_json_object(user, "$.consumer_units").cast("bigint").alias("consumer_units"),
        F.get_json_object(user, "$.fields.variables_count").cast("bigint").alias("variables_count"),
        F.md5(F.get_json_object(user, "$.sample")).alias("sample_digest"),
    )


def request_payload(t: Tables) -> DataFrame:
    """One request per message text, read back for what it holds."""
    requests = t.conversations.select(
        "conv_id", "turn", enrich.request_json(F.col("text")).alias("request")
    )
    schema = (
        "struct<messages: array<struct<role: string, content: string>>, "
        "max_tokens: int, temperature: int>"
    )
    parsed = requests.withColumn("r", F.from_json("request", schema))
    return parsed.select(
        "conv_id",
        "turn",
        F.size("r.messages").alias("messages"),
        F.array_join(F.transform("r.messages", lambda m: m["role"]), ",").alias("message_roles"),
        F.md5(F.col("r.messages")[1]["content"]).alias("user_digest"),
        F.col("r.max_tokens").alias("max_tokens"),
        F.col("r.temperature").alias("temperature"),
    )


def response_contract(t: Tables) -> DataFrame:
    checked = check_answers(roles.answers(t), "answer", TERMS)
    return checked.select(
        "document_id",
        "is_json",
        listed("missing"),
        listed("bad_values"),
        listed("bad_lengths"),
        listed("forbidden"),
        "accepted",
    )


def domain_contract(t: Tables) -> DataFrame:
    """Answers of the tagger, checked against the domain contract."""
    tagged = _tagged(t)
    sure = F.when(F.col("hits") > 20, "high").when(F.col("hits") > 0, "low")
    answer = F.to_json(
        F.struct(
            "business_domain",
            sure.alias("confidence"),
            F.array_compact(F.array("evidence_source")).alias("classification_evidence"),
            F.lit("keywords").alias("classification_reason"),
        )
    )
    checked = check_domain_answers(
        tagged.select("doc_id", answer.alias("answer")), "answer", DOMAIN_ANSWER
    )
    return checked.groupBy("business_domain", "confidence", "accepted").agg(
        F.count("*").alias("answers")
    )


def weakest_confidence(t: Tables) -> DataFrame:
    """The weakest of three confidences per label."""
    parts = [
        F.when(F.col("quality") == 1, "very-high").otherwise("medium"),
        F.when(F.col("toxic") == 1, "low").otherwise("high"),
        F.when(F.col("lang") == "en", "very-high").otherwise(F.col("lang")),
    ]
    found = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    return found.select("doc_id", weakest(*parts).alias("confidence"))


def token_cost(t: Tables) -> DataFrame:
    """Cost per model, over audit lines that were written and read back."""
    path = scratch_dir(t.spark, "tokens")
    append_json_lines(costs.token_audit(roles.model_responses(t)), path)
    schema = "model string, prompt_id string, tokens_in bigint, tokens_out bigint"
    return costs.token_cost(t.spark.read.schema(schema).json(path))


def _tagged(t: Tables) -> DataFrame:
    evidence = t.documents.select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("report_title"),
        F.col("source").alias("folder_path"),
        F.col("text").alias("additional_metadata"),
    )
    return tag_domain(
        evidence, ("report_title", "folder_path", "additional_metadata"), VOCABULARY
    )


def domain_tagger(t: Tables) -> DataFrame:
    return _tagged(t).select("doc_id", "business_domain", "evidence_source", "hits")


def domain_phrases(t: Tables) -> DataFrame:
    """The keyword table over titles and texts that hold its phrases, whole or in parts."""
    return tag_domain(roles.phrased(t), ("report_title", "additional_metadata")).select(
        "doc_id", "business_domain", "evidence_source", "hits"
    )


def latest_snapshot(t: Tables) -> DataFrame:
    return latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate")


QUERIES = (
    usage_matrix,
    consumer_profile,
    usage_pairs_v1,
    shortlist,
    shortlist_first,
    distinct_consumers,
    shortlist_audited,
    shortlist_share,
    units_detected,
    usage_category_counts,
    audit_by_unit,
    owner_list,
    owner_states,
    user_profile_clean,
    user_profile_all,
    user_unit_changed,
    universe_profile,
    universe_unmatched,
    universe_count,
    access_audit,
    audited_objects,
    impact_list,
    impacted_universes,
    file_metadata,
    freshness_counts,
    ingest_health_month,
    ingest_health_whole_months,
    column_fill,
    generations_by_name,
    bronze_flatten,
    provider_list,
    bronze_stream_load,
    reference_list_load,
    provider_sql_extract,
    extraction_to_bronze,
    flat_extract,
    sql_chunks,
    extraction_stats,
    run_totals,
    call_outcomes,
    providers_per_document,
    table_generations,
    worklist_update,
    worklist_rewrite,
    worklist_placeholders,
    registry_pending,
    export_paths,
    path_segments,
    field_dictionary,
    output_sample_text,
    output_sample_files,
    output_sample_columns,
    output_blocks,
    output_blocks_compat,
    enriched_documents,
    document_requests,
    request_payload,
    response_contract,
    domain_contract,
    weakest_confidence,
    token_cost,
    domain_tagger,
    domain_phrases,
    latest_snapshot,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_tables(query):
        return lambda spark, folder: query(Tables(spark, folder))

    return {query.__name__: over_tables(query) for query in QUERIES}
