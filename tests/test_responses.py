"""Landed responses at size: names, files and the first levels of plans."""

import glob
import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from reportarium.operators import queryplan
from reportarium.plans.extraction import land_responses
from reportarium.session import staged
from reportarium.sources.responses import classify_responses

NAMES = {
    "1_Details.json": (None, "document"),
    "1_Details(2).json": (None, "document"),
    "1_Details(x).json": (None, None),
    "1_Details.txt": (None, None),
    "1_Details.json.json": (None, None),
    "1_dataproviders_Response(12).json": ("dataproviders", "providers"),
    "1_DP(3)_Response.json": ("DP(3)", "detail"),
    "1_DP_queryplan_Response(1).json": ("DP", "queryplan"),
    "1_DP_queryplan_Response.json": ("DP", "queryplan"),
    ".json": (None, None),
}


def rows(spark, body="{}"):
    paths = [(f"API_Response_For_1/{name}", body) for name in NAMES]
    return spark.createDataFrame(paths, "path string, body string")


def test_names_with_and_without_a_number(spark):
    named = rows(spark).withColumn("body", F.concat(F.lit("{} "), F.substring_index("path", "/", -1)))
    got = {r.body[3:]: (r.part_id, r.kind) for r in classify_responses(named).collect()}
    assert got == NAMES


def test_landed_bodies_make_no_dictionary(spark, folder):
    """Bodies differ, so a dictionary is built for nothing (F1, F5)."""
    landed = land_responses(rows(spark), f"{folder}/responses")
    assert landed.filter("kind = 'queryplan'").count() == 2
    for file in glob.glob(f"{folder}/responses/*/*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        encodings = {e for c in range(group.num_columns) for e in group.column(c).encodings}
        assert not any("DICTIONARY" in e for e in encodings)


def test_usual_plans_pass_few_levels(spark, monkeypatch):
    """A plan of three levels is done in a first job of four; deeper ones take more jobs (F1, F5)."""
    plans = []

    def seen(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().count("variant_explode"))
        return staged(df, name)

    monkeypatch.setattr(queryplan, "staged", seen)
    pair = {"@index": "1", "$": "A"}
    for levels, jobs in ((1, [4]), (9, [4, 8]), (11, [4, 8, 8])):
        plans.clear()
        plan = {"x": [{"statement": pair}]}
        for _ in range(levels):
            plan = {"a": plan}
        body = spark.createDataFrame([(json.dumps({"queryplan": plan}),)], "body string")
        found = queryplan.with_statements(body, "body").collect()
        assert [tuple(s) for s in found[0].statements] == [("1", "A")]
        assert plans[1:] == jobs
