"""What is done, what is pending, and what was not found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportarium.functions.conditions import is_done
from reportarium.session import staged

# Fixed value: written for a listed report the service does not know.
NOT_FOUND = "Document Not Found on Server"


def pending(work: DataFrame, status: str = "extracted_status") -> DataFrame:
    """Rows of the work list that are not done; an empty status is not done."""
    return work.filter(~is_done(F.col(status)))


def unprocessed(df: DataFrame, registry: DataFrame, key: str = "document_id") -> DataFrame:
    """Rows whose key is not in the registry of processed ones."""
    return df.join(registry.select(key), key, "left_anti")


def update_work_list(work: DataFrame, processed: DataFrame) -> DataFrame:
    """Status and date of processed reports, others as they were.

    ``processed`` has one row per ``report_id`` with its new status and date.
    """
    new = processed.select(
        F.col("report_id").alias("__id"),
        F.col("extracted_status").alias("__status"),
        F.col("extracted_date").alias("__date"),
    )
    others = [c for c in work.columns if c not in ("extracted_status", "extracted_date")]
    return work.join(new, work.report_id == F.col("__id"), "left").select(
        *others,
        F.coalesce("__status", "extracted_status").alias("extracted_status"),
        F.coalesce("__date", "extracted_date").alias("extracted_date"),
    )


#: Folders of a stored work list. An update rewrites those that hold a report it names.
BUCKETS = 256


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("report_id"), F.lit(buckets)).cast("int").alias("bucket")


def store_work_list(work: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write a work list in folders by the hash of the report, one file each."""
    rows = work.select("*", _bucket(buckets)).repartition("bucket")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_work_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def rewrite_work_list(spark: SparkSession, path: str, processed: DataFrame, buckets: int = BUCKETS) -> None:
    """Bring a stored work list up to date; folders without a processed report are not touched.

    The new rows are settled beside the list before its folders are replaced, so a run that
    fails while it computes changes nothing, and one that is repeated gives the same list.
    """
    touched = processed.select(_bucket(buckets)).distinct().collect()  # at most ``buckets`` numbers
    numbers = sorted(r["bucket"] for r in touched if r["bucket"] is not None)
    work = spark.read.parquet(path).filter(F.col("bucket").isin(numbers))
    new = update_work_list(work.drop("bucket"), processed).select(*work.columns[:-1])
    settled = staged(new.select("*", _bucket(buckets)), "work-list").repartition("bucket")
    writer = settled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(path)


def with_placeholders(work: DataFrame, documents: DataFrame) -> DataFrame:
    """Details of every listed report; one not found has the marker for name and empty rest."""
    keep = [c for c in documents.columns if c not in ("document_id", "document_name", "document_cuid")]
    found = documents.withColumn("__found", F.lit(True))
    marker = lambda name: F.when(F.col("__found"), F.col(name)).otherwise(F.lit(NOT_FOUND))
    return work.join(found, work.report_id == found.document_id, "left").select(
        F.col("report_id").alias("document_id"),
        marker("document_cuid").alias("document_cuid"),
        marker("document_name").alias("document_name"),
        *keep,
        F.coalesce("__found", F.lit(False)).alias("found_on_server"),
    )
