"""Answers, tagger, requests and costs."""

import json

from pyspark.sql import functions as F

from reportarium.operators.contract import (
    CONFIDENCES,
    DOMAINS,
    ENTITIES,
    check_answers,
    check_domain_answers,
    sentence_count,
    weakest,
)
from reportarium.operators.tagger import EVIDENCE, KEYWORDS, tag_domain
from reportarium.plans.costs import token_audit, token_cost
from reportarium.plans.enrich import instructions, request_json
from reportarium.schemas import ANSWER, DOMAIN_ANSWER

WORDS = "Shows invoices and claims of one business area over time for the local team each month"
GOOD = {
    "report_name_in_english": "Invoices",
    "report_description": WORDS + ".",
    "monitored_entities": ["Invoice", "Claim"],
    "classification_evidence": ["title"],
    "report_purpose": "Operational",
    "report_purpose_description": "Daily work.",
    "geo_scope": "Domestic",
    "geo_scope_description": "One country.",
    "entity_subject": "Not Entity-Specific",
    "entity_subject_description": "Processes.",
    "confidence": "high",
}


def checked(spark, answers):
    df = spark.createDataFrame(list(enumerate(answers)), "id int, answer string")
    rows = {r.id: r for r in check_answers(df, "answer").collect()}
    return [rows[i] for i in range(len(answers))]


def test_list_sizes():
    assert (len(ENTITIES), len(DOMAINS), len(CONFIDENCES)) == (19, 21, 4)
    assert set(KEYWORDS) <= set(DOMAINS) and len(EVIDENCE) == 7 and len(ANSWER) == 11


def test_answers(spark):
    def changed(**changes):
        return json.dumps({**GOOD, **changes})

    no_scope = {k: v for k, v in GOOD.items() if k != "geo_scope"}
    words = WORDS.split()
    cases = [
        (json.dumps(GOOD), "", True),
        ("no json", "json", False),
        ("[1, 2]", "json", False),
        (json.dumps(no_scope), "missing:geo_scope", False),
        (changed(report_purpose="Strategic"), "bad_values:report_purpose", False),
        (changed(monitored_entities=["Invoice", "Robot"]), "bad_values:monitored_entities", False),
        (changed(monitored_entities=[]), "", True),
        (changed(report_description=" ".join(words[:14])), "bad_lengths:report_description", False),
        (changed(report_description=" ".join(words[:15])), "", True),
        (changed(report_description=" ".join(["word"] * 50)), "", True),
        (changed(report_description=" ".join(["word"] * 51)), "bad_lengths:report_description", False),
        (changed(report_description=WORDS + ". It is used. "), "bad_lengths:report_description_sentences", False),
        (changed(geo_scope_description="x " * 21), "bad_lengths:geo_scope_description", False),
        (changed(report_description=WORDS + " from an sql database."), "forbidden:SQL,database", False),
        (changed(report_description=WORDS + " with Power  BI."), "forbidden:Power BI", False),
    ]
    for row, (answer, finding, accepted) in zip(checked(spark, [c[0] for c in cases]), cases):
        found = [
            f"{name}:{','.join(row[name])}"
            for name in ("missing", "bad_values", "bad_lengths", "forbidden")
            if row[name]
        ]
        if finding == "json":
            assert not row.is_json and len(row.missing) == 11
        else:
            assert row.is_json and found == ([finding] if finding else []), answer
        assert row.accepted is accepted


def test_domain_answers(spark):
    good = {
        "business_domain": "Buyer Underwriting",
        "confidence": "low",
        "classification_evidence": [],
        "classification_reason": "x",
    }
    answers = [good, {**good, "business_domain": "Magic"}, {"confidence": "low"}]
    df = spark.createDataFrame([(i, json.dumps(a)) for i, a in enumerate(answers)], "id int, answer string")
    rows = {r.id: r for r in check_domain_answers(df, "answer", DOMAIN_ANSWER).collect()}
    assert [rows[i].accepted for i in range(3)] == [True, False, False]
    assert rows[1].bad_values == ["business_domain"] and len(rows[2].missing) == 3


def test_sentences(spark):
    cases = {"": 0, " ... ": 0, "One": 1, "One.": 1, "One. Two": 2, "3.5 tons": 1, "A! B? C.": 3, "Wait... what": 2}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", sentence_count(F.col("t"))).collect()} == cases


def test_weakest(spark):
    rows = [("high", "low", "low"), ("very-high", "odd", "very-high"), ("odd", None, None), ("medium", "high", "medium")]
    df = spark.createDataFrame(rows, "a string, b string, want string")
    for r in df.select("want", weakest(F.col("a"), F.col("b")).alias("got")).collect():
        assert r.got == r.want


def test_tagger(spark):
    none = dict.fromkeys(EVIDENCE)
    cases = [
        ({**none, "report_title": "Open CLAIMS, by brokers and claims"}, ("Claims and Recovery Management", "report_title", 2)),
        ({**none, "folder_path": "/credit   limits/", "owner": "ledger ledger"}, ("Buyer Underwriting", "folder_path", 1)),
        ({**none, "report_title": "claimsx underclaims", "consumers": "it-operations"}, ("IT Management", "consumers", 1)),
        ({**none, "variables": "products; policies"}, ("Contract Management", "variables", 1)),
        ({**none, "owner": "Collections after claim-events; debt collection"}, ("Claims and Recovery Management", "owner", 1)),
        ({**none, "owner": "debt collection operations. Collection registration"}, ("Collections Management", "owner", 2)),
        ({**none, "owner": "data quality metadata, master data quality"}, ("Data Management", "owner", 4)),
        (none, ("Unknown", None, 0)),
    ]
    schema = "id int, " + ", ".join(f"{e} string" for e in EVIDENCE)
    df = spark.createDataFrame([(i, *(c[e] for e in EVIDENCE)) for i, (c, _) in enumerate(cases)], schema)
    got = {r.id: (r.business_domain, r.evidence_source, r.hits) for r in tag_domain(df).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_request(spark):
    df = spark.createDataFrame([('say "hi"\n',)], "t string")
    request = json.loads(df.select(request_json(F.col("t"))).collect()[0][0])
    assert [m["role"] for m in request["messages"]] == ["system", "user"]
    assert request["messages"][1]["content"] == 'say "hi"\n'
    assert request["messages"][0]["content"] == instructions()
    assert (request["max_tokens"], request["temperature"]) == (1500, 0)


def test_costs(spark):
    bodies = [
        {"id": "1", "model": "m", "usage": {"prompt_tokens": 1_000_000, "completion_tokens": 500_000}},
        {"id": "2", "model": "m", "usage": {"prompt_tokens": 0, "completion_tokens": 500_000}},
    ]
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")
    row = token_cost(token_audit(df)).collect()[0]
    assert (row.calls, row.tokens_in, row.tokens_out, row.cost) == (2, 1_000_000, 1_000_000, 5.286)
