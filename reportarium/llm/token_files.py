"""Write the token ids of all documents, in order of document id, as Parquet files.

One row per document: its ids as a list column in dictionary encoding, and beside it the
columns that place it (document id, shard, tokens before it in its shard, number of tokens)
in delta encoding. Row groups and pages have fixed sizes, and pages an index, so readers of a
few documents or of the placing columns alone read little else.

Texts are dealt by range of document id, then encoded in that order inside the task that
writes the shard; a text hash breaks ties, so a repeated id spreads over several shards.
Null text: the end id alone. Null document ids come first. Empty table: files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportarium.llm.common import steps
from reportarium.llm.tokens import word_ids

END_ID = 1
#: Writer settings of the file format.
FORMAT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#shard_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, ids array<int>"


def write_token_files(
    documents: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID
) -> None:
    """Encode whole texts, append the end id, write the shards in document order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, start = word_ids(vocabulary), TaskContext.get().partitionId(), 0
        for batch in steps(batches):
            bounds, ids = encoder.encode(batch.column("text"))
            rows = len(batch)
            ids = np.insert(ids, bounds[1:], end_id).astype(np.int32)
            lengths = np.diff(bounds) + 1
            stops = np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(rows, shard, dtype=np.int32)),
                    pa.array(start + stops - lengths),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(np.concatenate([[0], stops]).astype(np.int32), ids),
                ],
                names=["doc_id", "shard", "shard_start", "n_tokens", "ids"],
            )
            start += int(lengths.sum())

    order = ["doc_id", F.xxhash64("text")]
    (
        documents.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
        .mapInArrow(encode, SCHEMA)
        .write.options(**FORMAT)
        .parquet(folder)
    )


def read_places(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens, without reading any ids."""
    rows = spark.read.schema(SCHEMA).parquet(folder).drop("ids")
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    bases = shards.select(
        F.col("shard"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")
    )
    return rows.join(bases, "shard").select(
        "doc_id", "shard", "shard_start", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens"
    )


def read_tokens(
    spark: SparkSession, folder: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """doc_id and ids of all documents, or of an id range, which prunes row groups and pages."""
    rows = spark.read.schema(SCHEMA).parquet(folder)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows.select("doc_id", "shard", "shard_start", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """The unsigned crc32 of each row's ids as little-endian unsigned 32-bit integers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds = lists.offsets.to_numpy()
            ids = lists.values.to_numpy().astype("<u4")
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("shard_start"), pa.array(sums, pa.int64())],
                names=["shard", "shard_start", "ids_crc32"],
            )

    return tokens.select("shard", "shard_start", "ids").mapInArrow(
        sums, "shard int, shard_start long, ids_crc32 long"
    )
