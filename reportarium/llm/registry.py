"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportarium.llm import (
    best_position,
    byte_bpe,
    checks,
    collocations,
    exact_topk,
    license_rules,
    packing,
    partition_join,
    posting_lists,
    secret_scan,
    super_minhash,
    token_files,
    tool_calls,
    toxicity,
)
from reportarium.llm.common import table
from reportarium.session import scratch_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def transcript_calls(conversations: DataFrame) -> DataFrame:
    """Turns in the role of tool calls: each assistant turn calls a tool with its text.

    A call needs the one two turns before, every third turn also the one four turns before.
    Some arguments break their schema or are no JSON, as in real transcripts.
    """
    text, size = F.col("text"), F.length("text")
    query = text.alias("query")
    search = F.when(
        size % 5 == 0, F.to_json(F.struct(query, F.lit("all").alias("limit")))
    ).otherwise(F.to_json(F.struct(query, (size % 10).alias("limit"))))
    first, even = F.element_at(F.split(text, " "), 1), size % 2 == 0
    lookup = F.to_json(F.struct(first.alias("key"), even.alias("exact")))
    count = F.to_json(F.struct(F.array(size, F.size(F.split(text, " "))).alias("terms")))
    pick = F.pmod(F.col("turn") + size, F.lit(4))
    earlier = F.array(
        F.concat(F.lit("call_"), F.col("turn") - 2),
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("call_"), F.col("turn") - 4)),
    )
    return conversations.filter(F.col("role") == "assistant").select(
        F.col("conv_id").alias("conversation"),
        F.concat(F.lit("call_"), F.col("turn")).alias("call_id"),
        F.col("turn").alias("position"),
        F.element_at(F.array(*map(F.lit, ("search", "lookup", "count", "render"))), pick.cast("int") + 1)
        .alias("tool"),
        F.when(size % 7 == 0, F.concat(F.lit("{"), text))
        .when(pick == 0, search)
        .when(pick == 1, lookup)
        .otherwise(count)
        .alias("arguments"),
        F.array_compact(earlier).alias("depends_on"),
    )


def transcript_results(conversations: DataFrame) -> DataFrame:
    """Turns in the role of results: each user turn answers the turn before it."""
    return conversations.filter((F.col("role") == "user") & (F.col("turn") > 0)).select(
        F.col("conv_id").alias("conversation"),
        F.concat(F.lit("call_"), F.col("turn") - 1).alias("call_id"),
        F.col("turn").alias("position"),
        F.col("text").alias("content"),
    )


#: The tools of the transcripts: name, kind and whether it is required, by parameter.
TOOLS = {
    "search": [("query", "string", True), ("limit", "integer", False)],
    "lookup": [("key", "string", True), ("exact", "boolean", False), ("scope", "string", True)],
    "count": [("terms", "array", True)],
}


def op1_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Each tool call with its result, its place in its conversation, and its JSON."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    schemas = spark.createDataFrame(
        list(TOOLS.items()), "tool string, schema array<struct<name:string,kind:string,required:boolean>>"
    )
    linked = tool_calls.link_calls(transcript_calls(turns), transcript_results(turns), schemas)
    return linked.select(
        F.col("conversation").alias("conv_id"),
        "call_id",
        "place",
        "level",
        "tool",
        F.array_join("errors", "; ").alias("errors"),
        "n_calls",
        "n_results",
        tool_calls.canonical().alias("message"),
    )


def op2_length_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack(table(spark, folder, "documents"), WORDS, keep_ids=False)


def op3_posting_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    return posting_lists.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


def op4_super_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its group of near duplicates, on shingles of four words."""
    return super_minhash.near_duplicates(table(spark, folder, "documents"), size=4)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for each document; a fifth of the ids is held out of training."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(~toxicity.held_out())
    scored = toxicity.score(documents, toxicity.fit(documents, labels))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and places of the secrets of each document."""
    found = secret_scan.find_secrets(table(spark, folder, "documents"))

    def number(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op7_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The licences of each document, in the order of their sentences."""
    found = license_rules.find_licences(table(spark, folder, "documents"))
    known = F.length(F.replace("identifiers", F.lit("."), F.lit("")))
    return found.select(
        "doc_id",
        F.length("identifiers").cast("long").alias("n_sentences"),
        known.cast("long").alias("n_known"),
        F.size("matches").cast("long").alias("n_licences"),
        F.array_join("licences", ",").alias("licences"),
        F.array_join("matches", ",").alias("matches"),
    )


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each document's ids and of the bytes they decode to."""
    return byte_bpe.tokenize(
        table(spark, folder, "documents"),
        RANKS,
        public_tokenizers.PATTERN,
        ("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op9_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 highest integer inner products of every fiftieth vector."""
    return exact_topk.top_k(table(spark, folder, "embeddings"), F.col("id") % 50 == 0, k=5)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Place, size and checksum of each document, read back from the files written."""
    files = scratch_dir(spark, "tokens")
    token_files.write_token_files(table(spark, folder, "documents"), files, WORDS)
    places = token_files.read_places(spark, files)
    sums = token_files.checksums(token_files.read_tokens(spark, files))
    return places.join(sums, ["shard", "shard_start"]).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 highest-scoring phrases of each language."""
    return collocations.collocations(table(spark, folder, "documents"))


def op12_partition_join(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with the group of documents that near ones reach, on shingles of five words."""
    return partition_join.similar_groups(table(spark, folder, "documents"), size=5)


def op13_best_position(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 documents that match each benchmark item best."""
    documents, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return best_position.ranked_search(documents, items, k=10)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_tool_calls": op1_tool_calls,
        "op2_length_packing": op2_length_packing,
        "op3_posting_lists": op3_posting_lists,
        "op4_super_minhash": op4_super_minhash,
        "op5_toxicity": op5_toxicity,
        "op6_secret_scan": op6_secret_scan,
        "op7_license_rules": op7_license_rules,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_exact_topk": op9_exact_topk,
        "op10_token_files": op10_token_files,
        "op11_collocations": op11_collocations,
        "op12_partition_join": op12_partition_join,
        "op13_best_position": op13_best_position,
    }


def sql() -> dict[str, str]:
    return checks.sql()
