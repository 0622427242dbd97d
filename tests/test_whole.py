"""Registered queries over rows of their own: whole results, and plans that hold at size."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from reportarium.operators.flatten import landed_id
from reportarium.operators.queryplan import PAIRS
from reportarium.plans import bronze, extraction
from reportarium.plans.bronze import load_batch, read_bronze
from reportarium.sources.documents import read_texts
from reportarium.sources.sinks import write_document_lines, write_quoted_csv
from reportarium.workload.roles import SCHEMAS, Tables, documented_providers

DAY = dt.datetime(2024, 1, 2, 3, 4, 5)
PARTS = (1, 2, 11, 102)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two orders, one with seven lines for each of some parts."""
    at = str(tmp_path_factory.mktemp("tables"))
    lines = [
        (1, part, 5, line, 1.0, 1.0, 0.0, 0.0, "N", "O", DAY) for part in PARTS for line in range(1, 8)
    ]
    rows = {
        "orders": [(n, 10 + n, "O", 1.0, DAY, "2-HIGH") for n in (1, 2)],
        "lineitem": lines,
        "part": [(part, f"name {part}", "B", "STANDARD", part % 50, 950.0) for part in PARTS],
        "supplier": [(5, "S", 1, 1.0)],
        "customer": [(11, "C", 1, 1.0, "BUILDING")],
        "events": [(4, DAY, 11, "view", 1.0, '{"k": 60}')],
        "nation": [(1, "N", 1)],
        "region": [(1, "R")],
    }
    for name, content in rows.items():
        spark.createDataFrame(content, SCHEMAS[name]).write.parquet(f"{at}/{name}.parquet")
    return at


@pytest.mark.parametrize("name", ["provider_sql_extract", "extraction_to_bronze"])
def test_every_nested_plan_gives_both_statements(spark, tables, name):
    rows = contract.queries()[name](spark, tables).filter("data_provider_id like 'DP-3-%'")
    got = sorted((r.data_source_id, r.sql_index, r.sql_query) for r in rows.collect())
    want = [
        (f"p{part}", index, f"SELECT * FROM t{part}" + more)
        for part in PARTS
        for index, more in (("1", ""), ("2", "\nUNION"))
    ]
    assert got == sorted(want)


def test_rows_of_a_batch_are_not_dealt_by_its_name(spark, tmp_path):
    """With no side small enough to be broadcast by its size, as in large tables."""
    rows = spark.range(10).select(
        F.col("id").cast("string").alias("landed_id"),
        F.lit(True).alias("has_provider"),
        F.col("id").cast("string").alias("document_id"),
    )
    rows.write.parquet(f"{tmp_path}/rows/load_batch=one")
    rows.write.parquet(f"{tmp_path}/rows/load_batch=crashed")
    rows.select("landed_id").write.parquet(f"{tmp_path}/registry/load_batch=one")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = read_bronze(spark, str(tmp_path))
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and read.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_landed_lines_and_flat_files_are_compressed(spark, tmp_path):
    rows = spark.range(3).select(F.lit('{"a": "b\n"}').alias("value"))
    write_document_lines(rows.select(F.lit("{}").alias("value")), f"{tmp_path}/lines")
    write_quoted_csv(rows, f"{tmp_path}/flat")
    for name in ("lines", "flat"):
        files = [f for f in os.listdir(f"{tmp_path}/{name}") if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
    assert spark.read.text(f"{tmp_path}/lines").count() == 3


def test_texts_of_flat_rows_are_made_behind_the_join(spark, tables):
    plan = documented_providers(Tables(spark, tables))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("SELECT") < plan.index("Join")
    assert "SELECT" not in plan[plan.index("Join") :]


def test_nothing_new_reads_no_text_again(spark, tmp_path, monkeypatch):
    os.makedirs(f"{tmp_path}/in")
    with open(f"{tmp_path}/in/a.json", "w") as f:
        f.write('{"Document_Details": {"Document_Id": 1}, "Data_Providers": [{"Data_Provider_ID": "x"}]}\n')
    texts = read_texts(spark, f"{tmp_path}/in", one_per_file=False)
    load_batch(spark, texts, f"{tmp_path}/out", "first")
    monkeypatch.setattr(bronze, "_chosen_rows", None)
    load_batch(spark, texts, f"{tmp_path}/out", "again")
    assert [r.document_id for r in read_bronze(spark, f"{tmp_path}/out").collect()] == ["1"]


def test_ids_are_read_in_one_pass(spark):
    texts = spark.createDataFrame(
        [
            ('{"Document_Details": {"Document_Id": 1}}',),
            ('[{"Document_Details": {"Document_Id": "2"}, "Extraction_Stats": {"Document_Id": 3}}]',),
            ('{"Document_Details": {"Document_Id": null}}',),
            ('{"Extraction_Stats": "text", "Document_Details": {"Document_Id": "4"}}',),
            ("no json",),
            (None,),
        ],
        "value string",
    )
    ids = texts.select(landed_id().alias("id"))
    assert [r.id for r in ids.collect()] == ["1", "3", None, "4", None, None]
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan


def test_facts_of_providers_travel_once_by_document(spark):
    listed = spark.createDataFrame(
        [("1", "a", "s"), ("1", "a", "s"), ("1", None, "s"), ("2", "b", "s")],
        "document_id string, data_provider_id string, data_source_id string",
    )
    details = spark.createDataFrame(
        [("1", "a", None, "n", None), ("1", "a", "unv", "n", "q"), ("1", "z", "unv", "n", "q")],
        "document_id string, data_provider_id string, type string, data_source_name string, property_sql string",
    )
    plans = spark.createDataFrame(
        [("1", "a", None), ("1", "a", [("1", "S")]), ("2", "b", None)],
        f"document_id string, data_provider_id string, statements {PAIRS}",
    )
    met = extraction._known_providers(listed, details, plans)
    got = sorted((r.document_id, r.data_provider_id or "", r.type, len(r.statements or [])) for r in met.collect())
    assert got == [("1", "", None, 0), ("1", "a", "unv", 1), ("1", "a", "unv", 1), ("2", "b", None, 0)]
    plan = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(document_id") == 1 and plan.count("Exchange") == 1
