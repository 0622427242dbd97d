"""Hot keys: a third of all rows under one key must be split between tasks."""

import pytest
from pyspark.sql import functions as F

from reportarium.operators.keys import look_up
from reportarium.operators.lists import distinct_records, record_lists
from reportarium.plans import silver, usage

# Small thresholds, so that test data counts as skewed, and no broadcast.
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("== Initial Plan ==")]


def hot(spark, rows=60_000):
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
        F.md5(F.col("id").cast("string")).alias("v"),
    )


def dimension(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    return keys.union(spark.createDataFrame([("hot",)], "key string")).withColumn("value", F.length("key"))


def test_look_up_splits_a_hot_key(skew):
    joined = look_up(hot(skew), F.col("k"), dimension(skew), F.col("key"), ["value"])
    assert "skew=true" in final_plan(joined)
    assert joined.filter("value is null").count() == 0 and joined.count() == 60_000


def test_records_of_a_hot_key_are_spread_before_they_are_listed(skew):
    listed = record_lists(hot(skew), ["k"], ["v"], "vs")
    plan = final_plan(listed)
    assert "hashpartitioning(k#" in plan and "v#" in plan[plan.rindex("hashpartitioning") :].split("]")[0]
    assert listed.agg(F.sum("vs_count")).collect()[0][0] == 60_000
    only = dimension(skew).select(F.col("key").alias("k"))
    wanted = distinct_records(hot(skew), ["k"], ["v"], only=only)
    assert "skew=true" in final_plan(wanted) and wanted.count() == 60_000


def test_audit_of_a_hot_report(skew):
    raw = hot(skew).select(
        F.col("k").alias("object"), F.col("k").alias("object_id"), F.lit("View").alias("event_type"),
        F.col("v").alias("user"), *(F.lit(n).alias(c) for c, n in (("year", 2024), ("month", 2), ("day", 3), ("hour", 4))),
        F.lit(1).alias("events"),
    )
    catalogue = dimension(skew).select(
        F.col("key").alias("report_id"), F.col("key").alias("report_cuid"), F.col("key").alias("report_name"),
        F.lit("Webi").alias("report_type"), F.lit(False).alias("report_instance"),
    )
    audit = silver.access_audit(raw, catalogue)
    assert "skew=true" in final_plan(audit)
    assert audit.filter("document_id is not null").count() == 60_000


def test_users_of_a_hot_report_and_a_hot_user(skew):
    rows = 60_000
    audit = skew.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 900).cast("string")).alias("document_id"),
        F.when(F.col("id") % 3 == 1, "robot").otherwise(F.concat(F.lit("u"), F.col("id") % 4001)).alias("user_name"),
    )
    directory = skew.range(4001).select(
        F.concat(F.lit("U"), "id").alias("user_id"), (F.col("id") % 7).cast("string").alias("bu"),
        F.lit("g").alias("bu_group"), (F.col("id") == 5).alias("is_controller"), F.lit(False).alias("is_manager"),
    )
    scope = audit.select("document_id").distinct()
    got = usage.document_users(audit, directory, scope)
    want = (
        audit.join(directory, F.upper("user_name") == F.col("user_id"), "left")
        .groupBy("document_id", "bu", "bu_group")
        .agg(F.countDistinct("user_name").alias("users"))
    )
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_impacted_tables_with_a_hot_table(skew):
    universes = hot(skew).select(F.col("v").alias("universe"), F.concat(F.lit("a,"), "k").alias("tables"))
    impact = dimension(skew).filter("key like 'k1%' or key = 'hot'").select(F.col("key").alias("table_name"))
    found = silver.impacted_universes(universes, impact)
    assert "skew=true" in final_plan(found)
    assert found.filter("risk_tag = 'Risk_Universe'").count() == hot(skew).filter("k like 'k1%' or k = 'hot'").select("v").distinct().count()
