"""Report outputs: one text file per report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportarium.functions.text import first_digits, path_segment, unix_lines


def read_outputs(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``file_path``, ``document_id`` (first digits of the file name), ``text``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"),
        first_digits(F.col("_metadata.file_name")).alias("document_id"),
        unix_lines(F.col("value")).alias("text"),
    )


def locate(outputs: DataFrame, paths: DataFrame) -> DataFrame:
    """Outputs of the documents that have an export path, matched by file name."""
    name = path_segment(F.col("file_path"))
    wanted = paths.select(
        F.col("document_id"), path_segment(F.col("export_path")).alias("__name")
    )
    return (
        outputs.drop("document_id")
        .withColumn("__name", name)
        .join(wanted, "__name")
        .select("document_id", "file_path", "text")
    )
