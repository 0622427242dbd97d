"""Small rows for the cases where the obvious reading goes wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reportarium.functions.conditions import any_true, is_done, truthy, usage_category
from reportarium.functions.names import clean_name, drop_unnamed
from reportarium.functions.text import (
    first_digits,
    path_segment,
    report_label,
    strip,
    without_scheme,
    word_count,
)
from reportarium.functions.times import from_parts, net_seconds, parsed
from reportarium.operators.queryplan import NO_PLAN, NO_SQL
from reportarium.operators.worklist import pending, update_work_list, with_placeholders
from reportarium.plans import extraction, silver, usage
from reportarium.plans.exports import export_paths
from reportarium.sources.responses import classify_responses, read_responses


def values(df, *columns):
    """One expression per column over all rows, as tuples."""
    return [tuple(r) for r in df.select(*columns).collect()]


# --- columns -----------------------------------------------------------------------


def test_event_classes(spark):
    df = spark.createDataFrame([("Edit",), ("Create",), ("View",), (None,), ("edit",)], "e string")
    assert [v[0] for v in values(df, usage_category(F.col("e")))] == [
        "Editor_events", "Editor_events", "Viewer_events", "Viewer_events", "Viewer_events",
    ]


def test_truth_of_texts(spark):
    df = spark.createDataFrame([("true",), ("false",), (None,), ("odd",), ("1",)], "s string")
    assert [v[0] for v in values(df, truthy(F.col("s")))] == [True, False, False, False, True]


def test_flag_of_a_group_of_nulls_is_false(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", None), ("b", True)], "k string, f boolean")
    assert dict(values(df.groupBy("k").agg(any_true(F.col("f")).alias("f")), "k", "f")) == {"a": False, "b": True}


def test_done_status_ignores_every_white_space(spark):
    df = spark.createDataFrame([("\tTrue\n",), ("TRUE",), ("FALSE",), (None,), ("",)], "extracted_status string")
    assert [v[0] for v in values(df, is_done(F.col("extracted_status")))] == [True, True, False, False, False]
    assert pending(df).count() == 3


def test_text_columns(spark):
    df = spark.createDataFrame([(" \t a b \n", "x/Output_12_34.json", "file:/e/a.csv")], "t string, p string, u string")
    row = values(
        df,
        strip(F.col("t")),
        word_count(F.col("t")),
        first_digits(F.col("p")),
        first_digits(F.col("t")),
        path_segment(F.col("p")),
        path_segment(F.col("p"), 2),
        path_segment(F.col("p"), 3),
        without_scheme(F.col("u")),
        report_label(F.lit(None), F.lit(3)),
    )[0]
    assert row[0] == "a b" and row[2:] == ("12", None, "Output_12_34.json", "x", None, "/e/a.csv", "Report 3")


def test_times(spark):
    df = spark.createDataFrame([(2024, 13, 1, 5), (2024, 2, 29, 23), (None, 1, 1, 1)], "y int, m int, d int, h int")
    got = [v[0] for v in values(df, from_parts(F.col("y"), F.col("m"), F.col("d"), F.col("h")))]
    assert got == [None, dt.datetime(2024, 2, 29, 23), None]
    times = spark.createDataFrame(
        [("2024-01-01 00:00:00.250000", "2024-01-01T00:00:20.5", 2), ("x", None, 0)], "a string, b string, p int"
    )
    net = net_seconds(parsed(F.col("a")), parsed(F.col("b")), F.col("p"))
    assert [v[0] for v in values(times, net)] == [10.25, None]
    summer = spark.createDataFrame([("2024-03-31 01:00:00", "2024-03-31 04:00:00", 0)], times.schema)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Amsterdam")
    try:
        assert values(summer, net)[0][0] == 10800.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("Name (x)", "Name_x"),
        ("A, B", "A_B"),
        (" lead ", "lead"),
        ("k=v", "k_v"),
        ("a-b\tc*", "a_b_c"),
        ("__x__", "x"),
        ("plain", "plain"),
    ],
)
def test_clean_names(name, want):
    assert clean_name(name) == want
    assert clean_name(clean_name(name)) == want


def test_unnamed_columns_go(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "Unnamed: 1", "_c2"])
    assert drop_unnamed(df).columns == ["a"]


# --- usage ---------------------------------------------------------------------------

DIRECTORY = "user_id string, bu string, bu_group string, is_controller boolean, is_manager boolean"
META = (
    "document_id string, document_name string, full_path string, created_by string, last_author string, "
    "scheduled boolean, file_location string, ingestion_ts timestamp_ntz"
)
DAY = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def estate(spark):
    directory = spark.createDataFrame(
        [
            ("ann", "Sales", "North", False, True),
            (" ANN ", "Tax", "South", True, False),  # a second entry of one user
            ("bob", "Sales", "North", True, False),
            ("cyd", None, None, False, False),
            ("eve", "Tax", "South", False, False),
        ],
        DIRECTORY,
    )
    metadata = spark.createDataFrame(
        [
            ("1", "Old", "/o", "bob", "eve", False, None, DAY),
            ("1", "One", "/1", "Ann ", "eve", True, "file:/1.csv", DAY + dt.timedelta(1)),
            ("2", "Two", "/2", None, "bob", False, "file:/2.csv", DAY),
            ("3", "Three", "/3", " administrator ", "eve", True, None, DAY),
            ("4", "Four", "/4", "ann", "ann", True, None, DAY),
            ("5", "Five", "/5", "zed", None, True, None, DAY),
            ("9", "Out of scope", "/9", "ann", "ann", True, None, DAY),
        ],
        META,
    )
    audit = spark.createDataFrame(
        [
            ("1", "ann", "Edit"),
            ("1", "ann", "View"),
            ("2", "BOB ", "View"),
            ("2", "ann", "View"),
            ("2", "eve", "View"),
            ("3", "cyd", "View"),
            ("3", "nobody", "View"),
            ("4", None, "View"),
            ("5", "bob", "Save"),
            ("9", "ann", "View"),
        ],
        "document_id string, user_name string, event_type string",
    )
    scope = spark.createDataFrame([(i,) for i in (*"1123456", None)], "document_id string")
    return metadata, audit, directory, scope


def test_matrix(estate):
    rows = usage.usage_matrix(*estate).collect()
    got = {(r.document_id, r.accessed_bu): r for r in rows}
    assert {k: r.accessed_users for k, r in got.items()} == {
        ("1", "Sales"): 1, ("2", "Sales"): 2, ("2", "Tax"): 1, ("3", None): 2, ("5", "Sales"): 1,
    }
    assert got["1", "Sales"].document_name == "One" and got["1", "Sales"].ownedby_bu == "Sales"
    assert got["2", "Sales"].ownedby_controller is True  # no creator: the last author
    assert got["3", None].ownedby_bu == "Tax"  # technical creator: the last author
    assert got["2", "Sales"].accessed_by_controller is True
    assert got["3", None].accessed_by_controller is False
    assert got["5", "Sales"].ownedby_bu is None


def test_profile_and_flags(estate):
    rows = {r.document_id: r for r in usage.consumer_profile(usage.usage_matrix(*estate)).collect()}
    assert set(rows) == {"1", "2", "3", "5"}
    assert (rows["1"].limited_to_owner_unit, rows["1"].personal_usage) == (True, True)
    assert (rows["2"].consumer_units, rows["2"].consumer_users) == (2, 3)
    assert [tuple(c) for c in rows["2"].consumers] == [("North", "Sales", 2), ("South", "Tax", 1)]
    assert rows["2"].limited_to_owner_unit is False
    assert (rows["3"].consumer_units, rows["3"].consumer_users, rows["3"].consumers) == (0, 0, [])
    assert rows["5"].limited_to_owner_unit is False  # owner unknown
    for r in rows.values():
        assert not r.personal_usage or r.limited_to_owner_unit
        assert not r.limited_to_owner_unit or r.consumer_units == 1


def test_unknown_unit_is_detected_but_no_consumer(estate):
    units = usage.units_detected(usage.usage_matrix(*estate)).collect()
    assert sorted(r.unit or "" for r in units) == ["", "Sales", "Tax"]


def test_owner_states_and_order(estate):
    metadata, audit, directory, scope = estate
    states = usage.owner_list(metadata, directory, scope, latest=False)
    assert states.filter("document_id = '1'").count() == 2
    pairs = usage.usage_pairs(metadata, audit, directory, scope).collect()
    keys = [(r.document_id, r.accessed_bu or "") for r in pairs]
    assert keys == sorted(keys) and len([k for k in keys if k[0] == "1"]) == 2


def test_shortlist(estate):
    metadata, audit, directory, scope = estate
    ids = [r.shortlist_id for r in usage.shortlist(scope, audit).collect()]
    assert sorted(ids) == ["1", "2", "3", "4", "5"]
    assert [r.shortlist_id for r in usage.shortlist(scope, audit, limit=2).collect()] == ["1", "2"]
    profile = {r.shortlist_id: r for r in usage.shortlist_profile(scope, audit, directory).collect()}
    assert (profile["2"].user_count, profile["2"].bu_count, profile["2"].total_in_scope) == (3, 2, 6)
    assert (profile["4"].user_count, profile["4"].bu_count) == (0, 0)


def test_export_paths_take_the_last_location(spark):
    snapshots = spark.createDataFrame(
        [(" 1", "file:/a.csv"), ("1", "file:/b.csv"), ("2", None)], "document_id string, file_location string"
    )
    listed = spark.createDataFrame([("1",), ("2",), ("3",)], "document_id string")
    assert [tuple(r) for r in export_paths(listed, snapshots).collect()] == [("1", "/b.csv")]


# --- silver ----------------------------------------------------------------------------


def test_user_profile(spark):
    current = spark.createDataFrame(
        [
            ("a", "Does not exist", "Does not exist", "Does not exist", "Does not exist", "NL"),
            ("b", "Bob", "Not applicable", "Sales", "b@x", "NL"),
            ("c", "Cyd", "Boss", "Does not exist", "c@x", None),
            ("d", "Dan", "Boss", "Tax", "d@x", "BE"),
        ],
        "user_name string, display_name string, title string, bu string, email_address string, country string",
    )
    old = spark.createDataFrame(
        [
            ("a", "Does not exist", "Does not exist", "Does not exist", DAY),
            ("b", "Older", "Older", "o@x", DAY - dt.timedelta(1)),
            ("b", "Tax", "Robert", "o@x", DAY),
            ("c", "Unidentified", "C", "c@o", DAY),
        ],
        "user_name string, business_unit string, display_name string, email_address string, ingestion_ts timestamp_ntz",
    )
    roles = spark.createDataFrame([("Boss", "Staff"), ("Boss", "Manager")], "title string, senior_level string")
    got = {r.user_name: r for r in silver.user_profile(current, old, roles, "2026-01-31").collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].display_name, got["a"].title, got["a"].bu, got["a"].bu_old, got["a"].email_address) == (
        ("Unidentified",) * 5
    )
    assert (got["b"].title, got["b"].bu, got["b"].bu_old) == ("External Resource", "Sales", "Tax")
    assert (got["c"].bu, got["c"].senior_level) == ("Left Organization", "Team lead")
    everyone = silver.user_profile(current, old, roles, "2026-01-31", keep_unmatched=True)
    assert everyone.count() == 4 and everyone.filter("user_name = 'd'").collect()[0].bu_old is None
    changed = silver.unit_changes(everyone)
    assert sorted(r.user_name for r in changed.collect()) == ["b", "c"]


def test_freshness_parses_times(spark):
    rows = [
        ("1", "2024-01-02", "2024-01-10"),  # as text 2024-01-02 < 2024-01-10 too
        ("1", "2024-01-02", "not a time"),
        ("2", "2024-10-01 00:00:00", "2024-9-30"),  # as text the other way round
        ("3", None, "2024-01-01"),
        ("4", "2024-01-01", "2024-01-01 00:00:00"),
        (None, "2024-01-01", "2023-01-01"),
    ]
    df = spark.createDataFrame(rows, "document_id string, updated string, refresh_time string")
    row = silver.freshness_counts(df).collect()[0]
    assert tuple(row) == (1, 1, 1, 1, 4)


def test_months_of_different_years(spark):
    df = spark.createDataFrame(
        [("1", True, DAY), ("2", True, DAY.replace(year=2025)), ("2", True, DAY)],
        "document_id string, scheduled boolean, ingestion_ts timestamp_ntz",
    )
    assert [tuple(r) for r in silver.ingest_health(df).collect()] == [(1, True, 2)]
    assert silver.ingest_health(df, whole_months=True).count() == 2


# --- work list -----------------------------------------------------------------------


def test_work_list(spark):
    work = spark.createDataFrame(
        [("1", None, None, "x"), ("2", "True", "2025-01-01", "y")],
        "report_id string, extracted_status string, extracted_date string, note string",
    )
    new = spark.createDataFrame([("1", "True", "2026-01-31")], "report_id string, extracted_status string, extracted_date string")
    updated = update_work_list(work, new)
    assert sorted(tuple(r) for r in updated.select(*work.columns).collect()) == [
        ("1", "True", "2026-01-31", "x"), ("2", "True", "2025-01-01", "y"),
    ]
    details = spark.createDataFrame([("2", "c2", None, "/p")], "document_id string, document_cuid string, document_name string, full_path string")
    rows = {r.document_id: r for r in with_placeholders(work.select("report_id"), details).collect()}
    assert rows["1"].document_name == "Document Not Found on Server" and rows["1"].full_path is None
    assert rows["2"].document_name is None and rows["2"].found_on_server is True


def test_registry_of_processed_reports(spark, folder):
    from reportarium.operators.worklist import unprocessed
    from reportarium.sources.sinks import append_json_lines

    reports = spark.createDataFrame([("1",), ("2",), ("3",)], "document_id string")
    append_json_lines(reports.filter("document_id = '2'"), f"{folder}/registry")
    registry = spark.read.schema("document_id string").json(f"{folder}/registry")
    todo = unprocessed(reports, registry)
    assert sorted(r.document_id for r in todo.collect()) == ["1", "3"]
    append_json_lines(reports.filter("document_id <> '2'"), f"{folder}/registry")
    registry = spark.read.schema("document_id string").json(f"{folder}/registry")
    assert unprocessed(reports, registry).count() == 0


# --- raw responses ---------------------------------------------------------------------


def test_response_files(spark, folder):
    import json
    import os

    def land(document, name, body):
        os.makedirs(f"{folder}/API_Response_For_{document}", exist_ok=True)
        with open(f"{folder}/API_Response_For_{document}/{document}_{name}.json", "w") as f:
            json.dump(body, f, indent=4)

    def provider(number, kind, **more):
        return {"dataprovider": {"id": number, "dataSourceType": kind, "dataSourceName": f"N {kind}", **more}}

    types = {"DP1": "fhsql", "DP2": "unx", "DP3": "unv", "DP4": "unv", "DP5": "excel", "DP6": "fhsql"}
    listed = [{"id": k, "name": k.lower(), "dataSourceId": 77, "dataSourceType": v} for k, v in types.items()]
    land(12, "Details", {"document": {"id": 12, "name": "Twelve", "cuid": "c", "createdBy": "u", "scheduled": True}})
    land(12, "dataproviders_Response", {"dataproviders": {"dataprovider": [*listed, {"id": "DP7"}]}})
    prop = {"properties": {"property": [{"@key": "x", "$": "no"}, {"@key": "sql", "$": "first"}, {"@key": "sql", "$": "last"}]}}
    for name, kind in types.items():
        land(12, f"{name}_Response", provider(name, kind, **(prop if name == "DP1" else {})))
    land(12, "DP1_Response(1)", provider("DP1", "fhsql", **prop))
    land(12, "DP2_queryplan_Response", {"queryplan": {"union": {"statement": [{"@index": "1", "$": "A"}, {"@index": "2", "$": "B"}]}}})
    land(12, "DP3_queryplan_Response", {"queryplan": {}})
    land(12, "DP4_queryplan_Response", {"queryplan": {"note": 1}})
    land(12, "5_Response", {"connection": {"@type": "Rel", "id": 5, "name": "C5", "database": "d", "networkLayer": "n"}})
    land(13, "Details", {"error_code": 404})
    look_ups = spark.createDataFrame([("77", "5"), ("77", "6")], "universe_id string, connection_id string")
    kinds = classify_responses(read_responses(spark, folder))
    assert {(r.kind, r.n) for r in kinds.groupBy("kind").agg(F.count("*").alias("n")).collect()} == {
        ("document", 2), ("providers", 1), ("detail", 7), ("queryplan", 3), ("connection", 1),
    }
    rows = extraction.provider_sql(kinds, look_ups).collect()
    got = {(r.data_provider_id, r.sql_index): (r.sql_query, r.connection_name) for r in rows}
    assert got == {
        ("DP1", "1"): ("last", None),
        ("DP2", "1"): ("A", "C5"),
        ("DP2", "2"): ("B", "C5"),
        ("DP3", "0"): (NO_PLAN, "C5"),
        ("DP4", "0"): (NO_SQL, "C5"),
        ("DP5", "0"): ("Data Source Type excel not handled for SQL extraction", None),
        ("DP6", "0"): ("", None),
        ("DP7", "0"): ("Data Source Type None not handled for SQL extraction", None),
    }
    assert len(rows) == 8 and {r.document_name for r in rows} == {"Twelve"}
    flat = extraction.flat_extract(
        extraction.provider_sql(kinds, look_ups), "Reports", size=10
    )
    assert len(flat.columns) == 37 and flat.filter('"is_Partial" is not null').count() == flat.count()
    pieces = flat.filter("dataprovider_id = 'DP5'").orderBy("sql_index").collect()
    assert "".join(p.sql_query for p in pieces) == got["DP5", "0"][0]
    assert pieces[0].sql_index == "0_0" and pieces[0].is_Partial is True


def test_extraction_stats(spark):
    def call(document, start, end, status=200):
        return (document, status, DAY + dt.timedelta(seconds=start), DAY + dt.timedelta(seconds=end))

    calls = spark.createDataFrame(
        [call("1", 0, 5), call("1", 5, 10.5), call("1", 16, 22, 404), call("2", 1, 2)],
        "document_id string, status int, started timestamp_ntz, ended timestamp_ntz",
    )
    rows = {r.document_id: r for r in extraction.extraction_stats(calls).collect()}
    assert (rows["1"].number_of_api_calls, rows["1"].api_pause_counts, rows["1"].execution_time_sec) == (3, 2, 12.0)
    assert rows["2"].execution_time_sec == 1.0
    assert tuple(extraction.run_totals(calls).collect()[0]) == (4, 2)
