"""Lists and keys under skew."""

import random

from pyspark.sql import functions as F

from reportarium.operators.chunks import chunk_text
from reportarium.operators.keys import latest_per_key, look_up, not_in, unique_dimension
from reportarium.operators.lists import distinct_records, record_lists
from reportarium.plans.enrich import enriched_documents
from reportarium.plans.fields import DEFINITION, field_dictionary, field_entries
from reportarium.plans.silver import impacted_universes


def skewed(spark, rows=3000):
    """A third of the rows belongs to one key, every value occurs twice."""
    return spark.range(rows).select(
        F.when(F.col("id") < rows / 3, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"),
        (F.col("id") / 2).cast("int").cast("string").alias("v"),
    )


def test_one_row_per_key_with_all_records_once(spark):
    listed = record_lists(skewed(spark), ["k"], ["v"], "vs")
    rows = {r.k: r for r in listed.collect()}
    assert len(rows) == listed.count() and rows["hot"].vs_count == 500
    assert all(len(set(r.vs)) == len(r.vs) == r.vs_count for r in rows.values())
    back = listed.select("k", F.explode("vs").alias("v"))
    df = skewed(spark)
    assert back.exceptAll(df.distinct()).count() == 0 and df.distinct().exceptAll(back).count() == 0


def test_lists_of_wanted_keys_only(spark):
    only = spark.createDataFrame([("hot",), ("k1",), ("none",), ("k1",)], "k string")
    listed = record_lists(skewed(spark), ["k"], ["v"], "vs", only=only)
    assert {r.k: r.vs_count for r in listed.collect()} == {"hot": 500, "k1": 20}


def test_a_key_of_100_000_records_and_many_repeats_keeps_its_shape(spark):
    rows = spark.range(400_000).select(
        F.when(F.col("id") < 300_000, "hot").otherwise("cold").alias("k"),
        F.when(F.col("id") < 300_000, F.col("id") % 100_000).otherwise(F.col("id") % 2).alias("v"),
    )
    listed = record_lists(rows, ["k"], ["v"], "vs")
    assert {r.k: r.vs_count for r in listed.select("k", "vs_count").collect()} == {"hot": 100_000, "cold": 2}
    assert distinct_records(rows, ["k"], ["v"]).count() == 100_002


def test_each_input_is_scanned_once(spark):
    path = "/root/testdata/sf0.001/lineitem.parquet"
    rows = spark.read.parquet(path).select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("v"))
    plan = record_lists(rows, ["k"], ["v"], "vs")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_hot_dictionary_is_enriched_whole(spark):
    entries = spark.range(500).select(
        F.when(F.col("id") < 400, "1").otherwise("2").alias("document_id"),
        *(F.concat(F.lit(c), F.col("id") % 300).alias(c) for c in DEFINITION),
    )
    scope = spark.createDataFrame([("1",), ("2",)], "document_id string")
    fields = field_dictionary(entries, scope)
    assert {r.document_id: r.variables_count for r in fields.collect()} == {"1": 300, "2": 100}
    assert field_entries(entries, scope).count() == 400
    profile = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "document_id string, p string")
    samples = spark.createDataFrame([("1", "s"), ("3", "s")], "document_id string, sample string")
    rows = enriched_documents(profile, fields, samples).collect()
    assert [(r.document_id, r.p, r.sample, r.fields.variables_count) for r in rows] == [("1", "a", "s", 300)]


def test_document_ids_of_other_types_and_padding_meet(spark):
    row = (" 1 ", *("x" for _ in DEFINITION))
    entries = spark.createDataFrame([row, row], ["document_id", *DEFINITION])
    scope = spark.createDataFrame([(1,)], "document_id bigint")
    assert [r.variables_count for r in field_dictionary(entries, scope).collect()] == [1]


def test_impacted_universe_with_many_tables(spark):
    tables = ",".join(f"t{i}" for i in range(60))
    universes = spark.createDataFrame(
        [("big", tables), ("safe", "x, ,"), ("none", None), ("big", "T1 , t2")], "universe string, tables string"
    )
    impact = spark.createDataFrame([(f" T{i}",) for i in range(50)], "table_name string")
    rows = impacted_universes(universes, impact).collect()
    big = [t for r in rows if r.universe == "big" for t in r.matched_tables]
    assert sorted(big) == sorted(f"t{i}" for i in range(50))
    tags = {r.universe: r.risk_tag for r in rows}
    assert tags == {"big": "Risk_Universe", "safe": "Safe", "none": "Safe"}


def test_latest_row_with_equal_stamps_is_stable(spark):
    rows = [("u", 1, "a"), ("u", 2, "b"), ("u", 2, "c"), ("v", None, "d"), ("v", 1, "e")]
    df = spark.createDataFrame(rows, "k string, ts int, v string")
    for parts in (1, 5):
        got = latest_per_key(df.repartition(parts), ["k"], "ts").collect()
        assert sorted(tuple(r) for r in got) == [("u", 2, "c"), ("v", 1, "e")]


def test_look_up_never_multiplies_rows(spark):
    dimension = spark.createDataFrame(
        [("a", 2), ("a", 1), (None, 9), ("b", None), ("b", 3)], "key string, value int"
    )
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "k string")
    assert unique_dimension(dimension, F.col("key"), ["value"]).count() == 2
    got = look_up(df, F.col("k"), dimension, F.col("key"), ["value"]).collect()
    assert sorted((r.k or "", r.value or 0) for r in got) == [("", 0), ("a", 1), ("a", 1), ("b", 3), ("z", 0)]


def test_anti_and_semi_join_make_the_whole(spark):
    known = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1)], "k string, part int")
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("b", 1, 3), ("c", 0, 4)], "k string, part int, n int")
    new = not_in(df, known, ["k", "part"])
    assert sorted(r.n for r in new.collect()) == [2, 4]
    assert new.count() + df.join(known, ["k", "part"], "left_semi").count() == df.count()


def test_chunks_join_back_to_the_text(spark):
    rng = random.Random(3)
    texts = [None, "", "a", "x" * 10, "x" * 11, "ab" * 10, "é\n😀" * 9]
    texts += ["".join(rng.choice("aé😀\n ") for _ in range(rng.randrange(80))) for _ in range(60)]
    df = spark.createDataFrame([(i, "7", t) for i, t in enumerate(texts)], "id int, idx string, sql string")
    got = {}
    for r in chunk_text(df, "sql", "idx", size=10).collect():
        got.setdefault(r.id, []).append(r)
    for i, text in enumerate(texts):
        pieces = sorted(got[i], key=lambda r: r.chunk_no)
        cut = text is not None and len(text) > 10
        assert [r.is_partial for r in pieces] == [cut] * len(pieces)
        assert [r.idx for r in pieces] == ([f"7_{n}" for n in range(len(pieces))] if cut else ["7"])
        if text is not None:
            assert "".join(r.sql for r in pieces) == text
            assert len(pieces) == max(1, -(-len(text) // 10))
            assert all(len(r.sql) == 10 for r in pieces[:-1])
