from datetime import datetime

import pytest

from tidemark.operators import analytics, routing, tenants
from tidemark.operators.constraints import Check, NotNull, Reference, Unique, check_constraints
from tidemark.registry import COMMON, PRACTICE, Table, Via

SESSION = Table("session", PRACTICE, ("s",))
USER = Table("user", PRACTICE, ("s", "u"), tenant=None, via=Via("s", "session", "s"))


@pytest.fixture
def installed(spark):
    return spark.createDataFrame([("O1", "A"), ("O2", "B")], "_org string, practice string")


def test_rows_find_their_practice(spark, rows, installed):
    sessions = spark.createDataFrame(
        [("s1", "{o1}"), ("s2", "O2 "), ("s2", "O2"), ("s3", "O9"), ("s4", None)],
        "s string, OrganisationGuid string",
    )
    routed = routing.route_rows(sessions, SESSION, installed)
    assert rows(routed, "s", "practice") == [
        ("s1", "A"), ("s2", "B"), ("s2", "B"), ("s3", None), ("s4", None),
    ]
    assert rows(routing.residual_rows(sessions, SESSION, installed), "s") == [("s3",), ("s4",)]
    users = spark.createDataFrame([("s1", "u"), ("s2", "u"), ("s3", "u"), ("s9", "u")], "s string, u string")
    # A parent sent twice doubles its rows; one without a practice gives none.
    via = routing.route_rows(users, USER, installed, routed)
    assert rows(via, "s", "practice") == [
        ("s1", "A"), ("s2", "B"), ("s2", "B"), ("s3", None), ("s9", None),
    ]
    assert rows(routing.counts_by_practice(via, "user")) == [
        ("user", "A", 1), ("user", "B", 2), ("user", None, 2),
    ]
    with pytest.raises(ValueError):
        routing.route_rows(users, USER, installed)


def test_organisations(spark, rows):
    sharing = spark.createDataFrame([("o1",), ("o2",), ("o3",), ("o4",)], "OrganisationGuid string")
    practices = spark.createDataFrame(
        [("O1", "Known", "K1", 1, "S1", 1, False, None)], tenants.PRACTICE_SCHEMA
    )
    detail = "OrganisationGuid string, CDB string, OrganisationName string, ODSCode string"
    staged = spark.createDataFrame([("O1", "1", "Other", "X"), ("O2", "2", "New", None)], detail)
    common = spark.createDataFrame([("O2", "9", "Old", "N2"), ("O3", "3", "Past", "N3")], detail)
    found = tenants.staging_organisations(sharing, practices, staged, common)
    assert rows(found) == [
        ("o1", True, True, "1", "Known", "K1", "S1"),
        ("o2", True, False, "2", "New", "N2", None),
        ("o3", True, False, "3", "Past", "N3", None),
        ("o4", False, False, None, None, None, None),
    ]
    new = tenants.new_practices(found, 4, "S")
    assert rows(new, "PracticeDBName", "ConfiguredAfter") == [("S2", 4), ("S3", 4)]
    assert tenants.already_configured(practices, new).isEmpty()
    active = tenants.activate_practices(practices.unionByName(new), 5, 4)
    assert rows(active, "CDB", "StartExtractId", "NewlyConfigured", "ConfiguredAfter") == [
        (1, 1, False, None), (2, 5, False, None), (3, 5, False, None),
    ]
    # Configured after another extract than the last one: not started yet.
    waiting = tenants.activate_practices(practices.unionByName(new), 7, 6)
    assert rows(waiting.where("CDB = 2"), "StartExtractId", "NewlyConfigured") == [(None, True)]


def test_gate(spark):
    log = spark.createDataFrame(
        [(1, 50, datetime(2017, 1, 9)), (2, 20, datetime(2017, 1, 5))],
        "ExtractId int, ProcessingIdEnd int, ExtractDate timestamp_ntz",
    )
    staged = spark.createDataFrame(
        [(1, datetime(2017, 1, 6)), (21, datetime(2017, 1, 5)), (99, datetime(2017, 1, 6))],
        "ProcessingIdStart int, ExtractDate timestamp_ntz",
    )
    found = tenants.install_gate(staged, log).collect()
    assert [r.Problem for r in found] == [None, tenants.NOT_LATER, None]
    assert {r.NextExtractId for r in found} == {3}
    first = tenants.install_gate(staged, log.where("false")).collect()
    assert [r.Problem for r in first] == [None, tenants.NOT_BULK, tenants.NOT_BULK]
    assert {(r.PreviousExtractId, r.NextExtractId) for r in first} == {(None, 1)}


def test_constraints(spark, rows):
    tables = {
        "a": spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (5, "z")], "k int, t string"),
        "b": spark.createDataFrame([(1,)], "k int"),
    }
    rules = {"a": [Unique(("k",)), Unique(("t",)), NotNull("k"), Reference("k", "b", "k"), Check("k < 5")]}
    assert rows(check_constraints(tables, rules), "Rule", "Violations") == [
        ("k < 5", 1), ("k in b (k)", 1), ("not null (k)", 1), ("unique (k)", 1), ("unique (t)", 1),
    ]


def test_practice_counts_include_empty_practices(spark):
    practices = spark.createDataFrame(
        [("One", "S1"), ("Two", "S2"), ("Three", "S3")], "PracticeName string, PracticeDBName string"
    )
    history = spark.createDataFrame(
        [("a", "S1", 1), ("b", "S2", 1), ("c", "S2", 1), ("c", "S2", 2)],
        "k string, practice string, ExtractId int",
    )
    found = analytics.practice_counts(practices, history, Table("t", PRACTICE, ("k",)))
    assert [tuple(r) for r in found.collect()] == [
        ("Two", "S2", 2), ("One", "S1", 1), ("Three", "S3", 0),
    ]


def test_code_counts(spark, rows):
    used = spark.createDataFrame(
        [("A", "1", "2017-01-02"), ("A", "1", "2017-01-01 10:00:00"), ("B", "1", "nonsense"),
         ("B", "2", None), ("B", None, "2017-01-01")],
        "practice string, CodeId string, EffectiveDate string",
    )
    by_practice = analytics.code_counts_by_practice(
        used, date=analytics.text_date("EffectiveDate")
    )
    total = analytics.total_code_counts(by_practice)
    assert rows(total) == [("1", datetime(2017, 1, 2), 3), ("2", None, 1)]
    assert rows(analytics.fold_code_counts(total, total), "CodeId", "CodeCount") == [
        ("1", 6), ("2", 2),
    ]
    only_a = spark.createDataFrame([("A",)], "practice string")
    again = analytics.refresh_code_counts(
        by_practice, by_practice.where("practice = 'A'"), only_a
    )
    assert rows(again, "practice", "CodeId", "CodeCount") == rows(
        by_practice, "practice", "CodeId", "CodeCount"
    )
    emptied = analytics.refresh_code_counts(by_practice, by_practice.limit(0), only_a)
    assert rows(emptied.select("practice").distinct()) == [("B",)]
    assert rows(analytics.code_rows_left_out(used)) == [("A", 2, 0, 0), ("B", 3, 1, 1)]
    codes = spark.createDataFrame(
        [("1", "old", 1), ("1", "new", 2), ("3", "unused", 1)],
        "CodeId string, Term string, ExtractId int",
    )
    table = Table("codes", COMMON, ("CodeId",), tenant=None)

    def described(state):
        found = analytics.describe_codes(total, codes, table, state=state, about=["Term"])
        return rows(found, "CodeId", "Term", "CodeCount")

    assert described("history") == [("1", "new", 3), ("1", "old", 3)]
    assert described("current") == [("1", "new", 3)]
    with pytest.raises(ValueError):
        analytics.describe_codes(total, codes, table, state="other")
    with pytest.raises(ValueError):
        analytics.for_each_practice(spark, "select 1", [], {})
    with pytest.raises(ValueError, match="too many"):
        analytics.for_each_practice(spark, "select 1", [str(i) for i in range(51)], {})
    with pytest.raises(ValueError):
        analytics.store_for_each_practice(spark, "select 1", [], {}, "/nowhere")
