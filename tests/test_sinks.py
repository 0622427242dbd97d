"""Writers and table steps."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportarium.functions.names import clean_names
from reportarium.session import scratch_dir, shared_root
from reportarium.sources.sinks import (
    add_timestamp_column,
    append_by_name,
    append_json_lines,
    replace_table,
    write_dated,
)
from reportarium.sources.tables import (
    conform,
    literal_rows,
    read_parquet,
    read_table,
    union_generations,
)


def test_append_goes_by_name(spark):
    replace_table(spark.createDataFrame([("a1", "b1")], "a string, b string"), "by_name")
    append_by_name(spark.createDataFrame([("b2", "a2", "c")], "b string, a string, c string"), "by_name")
    rows = sorted(tuple(r) for r in read_table(spark, "by_name").collect())
    assert rows == [("a1", "b1"), ("a2", "b2")]


def test_replace_may_change_columns(spark):
    replace_table(spark.range(3), "replaced")
    replace_table(spark.createDataFrame([("x",)], "name string"), "replaced")
    assert spark.table("replaced").columns == ["name"]


def test_added_timestamp_column_is_empty(spark):
    replace_table(spark.range(2), "stamped")
    add_timestamp_column(spark, "stamped")
    add_timestamp_column(spark, "stamped")
    table = spark.table("stamped")
    assert table.schema["ingestion_ts"].dataType == T.TimestampNTZType()
    assert [r.ingestion_ts for r in table.collect()] == [None, None]


def test_dated_folders_replace_their_own_day(spark, folder):
    write_dated(spark.range(3), folder, "2026-01-30")
    write_dated(spark.range(5), folder, "2026-01-31")
    write_dated(spark.range(4), folder, "2026-01-31")
    counts = read_parquet(spark, folder).groupBy(F.col("load_date").cast("string")).count()
    assert sorted(tuple(r) for r in counts.collect()) == [("2026-01-30", 3), ("2026-01-31", 4)]


def test_merged_schema(spark, folder):
    spark.range(1).write.parquet(f"{folder}/t/part=1")
    spark.range(1).withColumn("more", F.lit("x")).write.parquet(f"{folder}/t/part=2")
    assert set(read_parquet(spark, f"{folder}/t", merge_schema=True).columns) == {"id", "more", "part"}


def test_json_lines_append(spark, folder):
    append_json_lines(spark.range(2), f"{folder}/log")
    append_json_lines(spark.range(3), f"{folder}/log")
    assert spark.read.text(f"{folder}/log").count() == 5


def test_names_that_fall_together(spark):
    with pytest.raises(ValueError, match="fall together"):
        clean_names(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_rows_conform_to_a_schema(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert literal_rows(spark, schema, [{"b": 1, "z": 2}]).collect()[0].asDict() == {"a": None, "b": 1}
    assert literal_rows(spark, schema).count() == 0
    frame = spark.createDataFrame([("5", "x")], "B string, z string")
    assert conform(frame, schema).collect()[0].asDict() == {"a": None, "b": 5}


def test_generations_by_name(spark):
    both = union_generations(
        spark.createDataFrame([(1, "x")], "id int, name string"),
        spark.createDataFrame([("y", 2)], "extra string, id int"),
    )
    assert sorted(tuple(r) for r in both.collect()) == [(1, "x", None), (2, None, "y")]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = shared_root(spark)
    assert root == (named.rstrip("/") if named else spark.sparkContext.getCheckpointDir())
    assert scratch_dir(spark, "x").startswith(f"{root}/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
