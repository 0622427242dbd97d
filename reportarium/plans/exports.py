"""Where a report's output lies, and samples of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportarium.functions.text import without_scheme
from reportarium.operators.samples import (
    BLOCK_ROWS,
    SAMPLE_LINES,
    explode_blocks,
    sample_text,
    with_column_sample,
)


def export_paths(listed: DataFrame, snapshots: DataFrame) -> DataFrame:
    """``document_id, export_path`` of the listed documents that have an export.

    Of several locations the last in text order counts; the path loses its scheme.
    """
    located = (
        snapshots.filter("file_location is not null")
        .groupBy(F.trim("document_id").alias("__id"))
        .agg(F.max("file_location").alias("file_location"))
    )
    ids = listed.select("document_id").distinct()
    return ids.join(located, F.trim(ids.document_id) == F.col("__id")).select(
        "document_id", without_scheme(F.col("file_location")).alias("export_path")
    )


def text_samples(outputs: DataFrame, lines: int = SAMPLE_LINES) -> DataFrame:
    """``document_id, sample``: the first lines of each output."""
    return outputs.select("document_id", sample_text(F.col("text"), lines).alias("sample"))


def column_samples(outputs: DataFrame, samples: int = SAMPLE_LINES) -> DataFrame:
    """First values of each column of each output."""
    return with_column_sample(outputs, "text", samples).drop("text")


def output_blocks(outputs: DataFrame, rows: int = BLOCK_ROWS, compat: bool = False) -> DataFrame:
    """Titled table blocks of each output."""
    return explode_blocks(outputs, "text", rows, compat)
