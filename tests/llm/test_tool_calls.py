import json
import random

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from conftest import SMALL
from reportarium.llm import registry
from reportarium.llm.tool_calls import canonical, levels, link_calls, orphans

CALLS = "conversation long, call_id string, position long, tool string, arguments string, depends_on array<string>"
RESULTS = "conversation long, call_id string, position long, content string"
SCHEMAS = "tool string, schema array<struct<name:string,kind:string,required:boolean>>"
TOOL = [("find", [("q", "string", True), ("n", "integer", False), ("x", "number", False), ("o", "object", False)])]


def plain_levels(needs):
    """Longest chains by repeated visits; nodes of cycles, or behind them, have none."""
    level = {}
    while True:
        ready = {
            n: max((level[d] + 1 for d in own if d in needs), default=0)
            for n, own in needs.items()
            if n not in level and all(d in level for d in own if d in needs)
        }
        if not ready:
            return level
        level |= ready


def linked(spark, calls, results=(), schemas=TOOL):
    return link_calls(
        spark.createDataFrame(calls, CALLS),
        spark.createDataFrame(list(results), RESULTS),
        spark.createDataFrame(schemas, SCHEMAS),
    )


@pytest.mark.parametrize("seed, cyclic", [(1, False), (2, True), (3, False)])
def test_levels_of_random_graphs(spark, seed, cyclic):
    rnd = random.Random(seed)
    needs = {}
    for i in range(60):
        low = range(60) if cyclic else range(i)
        needs[str(i)] = [str(x) for x in rnd.sample(low, min(len(low), rnd.choice([0, 1, 1, 1, 2, 3])))]
    needs["0"] = ["unknown"]
    rows = [(7, i, own) for i, own in needs.items()]
    calls = spark.createDataFrame(rows, "conversation long, call_id string, depends_on array<string>")
    got = {r.node.split("\0")[1]: r.level for r in levels(calls).collect()}
    assert got == plain_levels(needs)


def test_long_chain_takes_few_rounds(spark):
    rows = [(1, str(i), [str(i - 1)]) for i in range(3000)]
    calls = spark.createDataFrame(rows, "conversation long, call_id string, depends_on array<string>")
    assert {r.node.split("\0")[1]: r.level for r in levels(calls).collect()} == {str(i): i for i in range(3000)}


def test_places_follow_levels_and_cycles_come_last(spark):
    calls = [
        (1, "c", 0, "find", "{}", ["b"]),
        (1, "b", 1, "find", "{}", ["a"]),
        (1, "a", 2, "find", "{}", []),
        (1, "x", 3, "find", "{}", ["y"]),
        (1, "y", 4, "find", "{}", ["x"]),
        (1, "z", 5, "find", "{}", ["z"]),
        (2, "c", 9, "find", "{}", ["a"]),
    ]
    rows = linked(spark, calls).orderBy("conversation", "place").collect()
    assert [(r.conversation, r.call_id, r.level, r.place) for r in rows] == [
        (1, "a", 0, 1), (1, "b", 1, 2), (1, "c", 2, 3), (1, "x", None, 4), (1, "y", None, 5),
        (1, "z", None, 6), (2, "c", 0, 1),
    ]


def test_arguments_are_held_against_the_schema(spark):
    cases = {
        '{"q": "a"}': [],
        '{"n": 3, "q": "a", "x": 1.5}': [],
        '{"q": "a", "n": 1.5}': ["not integer n"],
        '{"q": 1, "x": true}': ["not string q", "not number x"],
        '{"z": 1, "b": 2}': ["missing q", "unknown b", "unknown z"],
        '{"q": null}': ["not string q"],
        '{"q": "a", "o": {"b": [1, {"d": 1, "c": 2}], "a": null}}': [],
        '{"q": "a"': ["not JSON"],
        "[1]": ["not an object"],
        "": ["not JSON"],
    }
    calls = [(1, str(i), i, "find", text, None) for i, text in enumerate(cases)]
    calls += [(1, "none", 90, "find", None, None), (1, "other", 91, "grep", "{}", None), (1, "null", 92, None, "{}", None)]
    rows = {r.call_id: r for r in linked(spark, calls).collect()}
    for i, (text, errors) in enumerate(cases.items()):
        assert rows[str(i)].errors == errors, text
    assert rows["none"].errors == ["not JSON"]
    assert rows["other"].errors == rows["null"].errors == ["unknown tool"]
    assert rows["6"].arguments == '{"o":{"a":null,"b":[1,{"c":2,"d":1}]},"q":"a"}'


def test_canonical_json_has_sorted_keys(spark):
    calls = [(1, "k", 0, "find", '{ "q" : "ü\\n\\"", "n" : 2 }', None)]
    row = linked(spark, calls, [(1, "k", 1, "fine")]).select(canonical().alias("json")).first()
    assert row.json == '{"arguments":{"n":2,"q":"ü\\n\\""},"id":"k","name":"find","result":"fine"}'
    assert json.loads(row.json)["result"] == "fine"


def test_odd_rows(spark):
    calls = [
        (1, "a", 5, "find", "{}", ["b", None]),
        (1, "a", 3, "find", '{"q":"first"}', []),
        (1, "a", 3, "find", '{"q":"first"}', []),
        (None, "a", 0, "find", None, None),
        (1, None, 8, "find", "{}", None),
        (None, None, None, None, None, None),
        (2, "long", 0, "find", json.dumps({"q": "y" * 200_000}), None),
    ]
    results = [(1, "a", 9, "late"), (1, "a", 8, "early"), (None, "a", 1, None), (1, None, 1, "x"), (3, "a", 0, "lost")]
    rows = linked(spark, calls, results).collect()
    assert len(rows) == 5
    by = {(r.conversation, r.call_id): r for r in rows}
    assert by[1, "a"].arguments == '{"q":"first"}' and by[1, "a"].n_calls == 3
    assert by[1, "a"].result == "early" and by[1, "a"].n_results == 2
    assert by[None, "a"].n_results == 1 and by[None, "a"].result is None
    assert by[1, None].level == 0 and by[1, None].n_results == 0
    assert by[2, "long"].errors == []
    lost = orphans(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS))
    assert sorted((r.conversation, r.content) for r in lost.collect()) == [(1, "x"), (3, "lost")]
    assert linked(spark, []).collect() == []
    extra = spark.createDataFrame(calls, CALLS).withColumns({c: F.lit(1) for c in ("node", "level", "result")})
    empty = spark.createDataFrame([], RESULTS)
    assert link_calls(extra, empty, spark.createDataFrame(TOOL, SCHEMAS)).count() == 5


@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
@pytest.mark.parametrize("name", sorted(registry.sql()))
def test_queries_equal_sql(spark, name, folder):
    query = registry.registered()[name](spark, folder)
    assert differences(query, registry.sql()[name], connect(folder)) is None


def test_plan_is_native(spark):
    plan = registry.op1_tool_calls(spark, SMALL)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "CartesianProduct"))
