"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportarium.session import scratch_dir

#: Texts of one step inside a task, in bytes; one longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def steps(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded text size; null texts become empty."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(at).cast(pa.large_string()), "")
        batch = batch.set_column(at, column, texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def ranked(df: DataFrame, group: list[str], order: list[Column | str], name: str) -> DataFrame:
    """Number rows from 1 within each group, without bringing a group into one task.

    Rows are dealt by range of (group, order); a group that spans several ranges gets the
    rows of the ranges before as a start. Equal rows are numbered in any order.
    """
    columns = df.columns
    dealt = staged(
        df.repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id()),
        "ranked",
    )
    same = [F.col(c) for c in group]
    sizes = dealt.groupBy(*same, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*same).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"__of_{c}") for c in group],
        F.col("__range").alias("__start_range"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
    )
    inside = Window.partitionBy(*same, "__range").orderBy(*order)
    numbered = dealt.withColumn("__own", F.row_number().over(inside))
    match = F.col("__range") == F.col("__start_range")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    return numbered.join(starts, match).select(
        *columns, (F.col("__own") + F.col("__before")).cast("long").alias(name)
    )
