"""Output files written under a commit and read by their heads."""

import os

import pytest
from pyspark.sql import functions as F

from reportarium.operators.samples import sample_text, with_column_sample
from reportarium.sources.output_files import BUFFER, read_heads, write_outputs


def files(folder):
    return [os.path.join(d, n) for d, _, names in os.walk(folder) for n in names]


def test_many_documents_are_written_and_read_back(spark, folder):
    number = 60_000
    rows = spark.range(number).select(
        F.concat(F.lit("WEBI_"), "id", F.lit(".csv")).alias("name"),
        F.concat(F.lit("a\tb\n"), F.col("id").cast("string"), F.lit("\tx\n")).alias("text"),
    )
    write_outputs(rows, folder)
    found = read_heads(spark, folder)
    assert found.rdd.getNumPartitions() == 60
    row = found.agg(F.count("*"), F.countDistinct("document_id"), F.min("text"), F.max("text")).first()
    assert tuple(row) == (number, number, "a\tb\n0\tx\n", "a\tb\n9999\tx\n")
    assert found.filter(F.split("text", "[\t\n]")[2] != F.col("document_id")).isEmpty()


def test_a_failed_task_leaves_nothing_and_earlier_files_stay(spark, folder):
    good = spark.createDataFrame([("1.csv", "x"), ("2.csv", None)], "name string, text string")
    write_outputs(good, folder)
    before = files(folder)
    bad = spark.range(200).repartition(4).select(
        F.when(F.col("id") != 150, F.concat("id", F.lit(".csv"))).alias("name"), F.lit("y").alias("text")
    )
    with pytest.raises(Exception, match="no name of a file"):
        write_outputs(bad, folder)
    assert files(folder) == before
    assert {(r.document_id, r.text) for r in read_heads(spark, folder).collect()} == {("1", "x"), ("2", "")}
    write_outputs(good.limit(1), folder, "overwrite")
    assert [r.document_id for r in read_heads(spark, folder).collect()] == ["1"]


def test_no_rows_make_no_files(spark, folder):
    write_outputs(spark.createDataFrame([], "name string, text string"), folder)
    assert read_heads(spark, folder).count() == 0
    assert read_heads(spark, f"{folder}/none").count() == 0


def test_of_a_file_its_head_is_read(spark, folder):
    texts = {
        "long 1.csv": "h1\th2\n" + "1\t2\n" * 500_000,
        "blank 2.csv": "h1\th2\n" + "\n" * 40 + '"a\nb"\t2\n' * 20 + "z\tz\n" * 500_000,
        "short 3.csv": "h1\th2\r\n1\t2",
        "wide 4.csv": "h\n" + "x" * 100_000 + "\n",
        "empty 5.csv": "",
    }
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", newline="") as f:
            f.write(text)
    found = {r.document_id: r for r in read_heads(spark, folder).collect()}
    assert len(found) == 5 and all(
        r.bytes_read <= len(r.text.encode()) + 2 * BUFFER for r in found.values()
    )
    plain = {n.split()[1][0]: t.replace("\r\n", "\n") for n, t in texts.items()}
    assert all(plain[i].startswith(r.text) for i, r in found.items())
    whole = spark.createDataFrame(list(plain.items()), "document_id string, text string")
    for df in (whole, read_heads(spark, folder)):
        sampled = with_column_sample(df, "text").select("document_id", "columns", "sample_text", sample_text(F.col("text")))
        rows = {r.document_id: tuple(r)[1:] for r in sampled.collect()}
        first = rows if df is whole else first
    assert rows == first


def test_heads_stop_after_the_records_asked_for(spark, folder):
    with open(f"{folder}/7.csv", "w") as f:
        f.write("".join(f"{i}\n" for i in range(100)))
    (row,) = read_heads(spark, folder, records=3).collect()
    assert row.text == "0\n1\n2\n3\n"
