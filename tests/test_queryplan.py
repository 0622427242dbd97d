"""Statements of query plans against a plain statement of the walk."""

import json
import random

from reportarium.operators import queryplan
from reportarium.operators.queryplan import UNREADABLE, with_statements
from reportarium.session import staged


def rule(plan):
    """Pairs of a plan: children first, by name; in lists a ``statement`` replaces its object."""
    if not isinstance(plan, dict):
        return []
    found = []
    for _, value in sorted(plan.items()):
        if isinstance(value, dict):
            found += rule(value)
        if isinstance(value, list):
            found += in_list(value)
    return found + own(plan)


def in_list(items):
    found = []
    for item in items:
        if isinstance(item, dict) and item.get("statement"):
            inside = item["statement"]
            found += in_list(inside) if isinstance(inside, list) else own(inside)
        elif isinstance(item, dict):
            found += own(item)
    return found


def own(plan):
    index, sql = plan.get("@index", ""), plan.get("$", "")
    if isinstance(index, (dict, list)) or isinstance(sql, (dict, list)) or "" in (index, sql):
        return []
    return [(str(index), str(sql))]


def pair(rng):
    made = {}
    if rng.random() < 0.8:
        made["@index"] = rng.choice(["1", "2", "", 3])
    if rng.random() < 0.8:
        made["$"] = rng.choice(["SELECT 1", "SELECT 'x\ny'", ""])
    return made


def random_plan(rng, depth):
    plan = pair(rng)
    for _ in range(rng.randrange(0, 3)):
        name = rng.choice(["statement", "union", "join", "part"])
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            plan[name] = pair(rng)
        elif kind < 0.6:
            plan[name] = random_plan(rng, depth - 1)
        else:
            items = []
            for _ in range(rng.randrange(0, 3)):
                item = pair(rng)
                if rng.random() < 0.4:
                    item["statement"] = [pair(rng) for _ in range(rng.randrange(0, 3))]
                items.append(item)
            plan[name] = items
    return plan


def statements(spark, bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    found = {}
    for row in with_statements(df, "body").collect():
        found[row.id] = None if row.statements is None else [tuple(s) for s in row.statements]
    return [found[i] for i in range(len(bodies))]


def test_known_shapes(spark):
    one, two = {"@index": "1", "$": "A"}, {"@index": "2", "$": "B"}
    plans = [
        ({"statement": one}, [("1", "A")]),
        ({"statement": [one, two]}, [("1", "A"), ("2", "B")]),
        ({"union": {"statement": [one, two]}}, [("1", "A"), ("2", "B")]),
        ({"union": [{"statement": [one]}, two], "@index": "3", "$": "C"}, [("1", "A"), ("2", "B"), ("3", "C")]),
        ({"list": [{"inner": one}]}, []),
        ({"status": "empty"}, []),
        ({}, None),
    ]
    got = statements(spark, [json.dumps({"queryplan": p}) for p, _ in plans])
    assert got == [want for _, want in plans]


def test_unreadable_and_missing(spark):
    assert statements(spark, ["no json", "{}", '{"queryplan": []}', '{"queryplan": ["x"]}']) == [
        [("0", UNREADABLE)],
        None,
        None,
        [],
    ]


def test_random_plans(spark):
    rng = random.Random(11)
    plans = [random_plan(rng, 3) for _ in range(400)]
    got = statements(spark, [json.dumps({"queryplan": p}) for p in plans])
    for plan, found in zip(plans, got):
        assert found == (rule(plan) if plan else None), json.dumps(plan)


def deep(levels):
    """A plan as text, as a nested value of that depth could not be written out either."""
    return '{"a": ' * levels + '{"x": [{"statement": {"@index": 9, "$": "deep"}}]}' + "}" * levels


def test_deep_plans_in_one_session(spark):
    bodies = [f'{{"queryplan": {deep(n)}}}' for n in (3, 7, 8, 40, 390)]
    assert statements(spark, bodies) == [[("9", "deep")]] * len(bodies)


def test_what_the_parser_does_not_take_gives_the_marker_at_every_size(spark):
    bodies = []
    for levels in (5, 5000, 60_000):
        whole = f'{{"queryplan": {deep(levels)}}}'
        bodies += [whole[:-3], whole.replace("}]}", "]}}", 1), whole.replace('9, "$"', '9 "$"'), whole + "x"]
    bodies += [f'{{"queryplan": {deep(n)}}}' for n in (5000, 60_000)]
    assert statements(spark, bodies) == [[("0", UNREADABLE)]] * len(bodies)


def test_repeated_bodies_keep_their_statements_apart(spark):
    plan = {"union": {"statement": [{"@index": "1", "$": "A"}, {"@index": "2", "$": "B"}]}}
    assert statements(spark, [json.dumps({"queryplan": plan})] * 3 + [None]) == [[("1", "A"), ("2", "B")]] * 3 + [None]


def test_wide_plans_are_no_deep_ones(spark):
    pairs = [{"@index": str(i), "$": f"S{i} {{["} for i in range(2000)]
    assert statements(spark, [json.dumps({"queryplan": {"statement": pairs}})]) == [
        [(p["@index"], p["$"]) for p in pairs]
    ]


def test_a_body_is_parsed_once_and_by_no_python(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(
        queryplan, "staged", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), staged(df, name))[1]
    )
    body = json.dumps({"queryplan": {"a": {"b": [{"@index": "1", "$": "A"}]}}})
    assert statements(spark, [body]) == [[("1", "A")]]
    assert [p.count(f',"{queryplan.END}"]') for p in plans] == [1, 0]
    assert len(plans) == 2 and not any("Python" in p or "Arrow" in p for p in plans)
