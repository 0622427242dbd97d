"""Reference lists: delimited files with a header, every column text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reportarium.functions.names import clean_names, drop_unnamed


def read_list(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Text columns only: no inference, hence one read and no lost leading zeros."""
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def read_reference_list(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A list with spreadsheet left-overs dropped and its names made fit for a table."""
    return clean_names(drop_unnamed(read_list(spark, path, sep)))
