"""A stored work list, rewritten in place."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from reportarium.operators.worklist import read_work_list, rewrite_work_list, store_work_list


def files(folder):
    """Each data file of a folder with its digest and time."""
    found = {}
    for top, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(top, name)
                with open(path, "rb") as f:
                    found[path] = (hashlib.sha256(f.read()).hexdigest(), os.stat(path).st_mtime_ns)
    return found


def stored(spark, folder, number=5000):
    rows = spark.range(number).select(
        F.col("id").cast("string").alias("report_id"),
        F.lit("FALSE").alias("extracted_status"),
        F.lit(None).cast("string").alias("extracted_date"),
        (F.col("id") % 7).alias("more"),
    )
    store_work_list(rows, folder, buckets=64)
    return number


def done(spark, ids):
    rows = [(i, "True", "2026-01-31") for i in ids]
    return spark.createDataFrame(rows, "report_id string, extracted_status string, extracted_date string")


def test_only_folders_of_processed_reports_are_rewritten(spark, folder):
    number = stored(spark, folder)
    before = files(folder)
    ids = [str(i) for i in range(0, number, 500)] + ["not listed"]
    rewrite_work_list(spark, folder, done(spark, ids), buckets=64)
    after = files(folder)
    same = before.keys() & after.keys()
    assert len(before) == len(after) == 64 and 64 - len(ids) <= len(same) < 64
    assert all(before[f] == after[f] for f in same)
    got = read_work_list(spark, folder)
    assert got.columns == ["report_id", "extracted_status", "extracted_date", "more"]
    rows = {r.report_id: r for r in got.collect()}
    assert len(rows) == number
    for i, r in rows.items():
        assert (r.extracted_status, r.extracted_date) == (("True", "2026-01-31") if i in ids else ("FALSE", None))
        assert r.more == int(i) % 7
    rewrite_work_list(spark, folder, done(spark, ids), buckets=64)
    assert sorted(read_work_list(spark, folder).collect()) == sorted(rows.values())


def test_nothing_processed_changes_nothing(spark, folder):
    stored(spark, folder, 300)
    before = files(folder)
    rewrite_work_list(spark, folder, done(spark, []), buckets=64)
    rewrite_work_list(spark, folder, done(spark, [None]), buckets=64)
    assert read_work_list(spark, folder).count() == 300
    changed = {f for f in before if before[f] != files(folder).get(f)}
    assert len(changed) <= 1


def test_a_run_that_fails_changes_nothing(spark, folder):
    stored(spark, folder, 300)
    before = files(folder)
    bad = done(spark, ["5"]).withColumn("extracted_date", F.raise_error(F.lit("no date")).cast("string"))
    with pytest.raises(Exception, match="no date"):
        rewrite_work_list(spark, folder, bad, buckets=64)
    assert files(folder) == before
