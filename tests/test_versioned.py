import random
from collections import Counter

import pytest

from tidemark.operators import versioned
from tidemark.registry import PRACTICE, Registry, Table
from tidemark.sources.history import save_bucketed
from tidemark.sources.shared import new_folder
from tidemark.sources.views import register_views

TABLE = Table("t", PRACTICE, ("a", "b"), deleted="Deleted")
SCHEMA = "v string, a string, b string, Deleted string, practice string, ExtractId int"


def histories(seed, size=400):
    """Random versions with ties, copies, null key parts and odd delete flags."""
    pick = random.Random(seed)
    return [
        (
            pick.choice("xyz"),
            pick.choice(["k1", "k2", "k3", None]),
            pick.choice(["m", "n", None]),
            pick.choice(["false", "false", "false", "true", "", None, "FALSE"]),
            f"case{pick.randrange(25)}",
            pick.randrange(1, 7),
        )
        for _ in range(size)
    ]


def state(rows, n):
    newest = {}
    for v, a, b, d, p, e in rows:
        if a is not None and b is not None and (n is None or e <= n):
            newest[p, a, b] = max(newest.get((p, a, b), 0), e)
    return [r for r in rows if newest.get((r[4], r[1], r[2])) == r[5]]


def alive(rows):
    return [r for r in rows if r[3] == "false"]


@pytest.mark.parametrize("n", [None, 1, 3, 6])
def test_as_of_against_brute_force(spark, n):
    data = histories(n or 0)
    df = spark.createDataFrame(data, SCHEMA)
    expected = Counter(alive(state(data, n)))
    by_join = versioned.as_of(df, TABLE, n)
    assert by_join.columns == df.columns
    assert Counter(map(tuple, by_join.collect())) == expected
    register_views(spark, {"t": df}, Registry((TABLE,)))
    by_function = spark.sql(f"select * from fn_t({n or 'null'})")
    assert Counter(map(tuple, by_function.collect())) == expected
    if n is None:
        assert Counter(map(tuple, spark.table("vw_t").collect())) == expected
    by_window = versioned.as_of(df, TABLE, n, in_place=True)
    assert Counter(map(tuple, by_window.collect())) == expected


@pytest.mark.parametrize("before,after", [(1, 2), (2, 5)])
def test_diff_against_brute_force(spark, before, after):
    data = histories(before * 10 + after)
    old, new = alive(state(data, before)), alive(state(data, after))
    expected = {}
    for key in {(r[4], r[1], r[2]) for r in old + new}:
        was = Counter((r[0], r[3]) for r in old if (r[4], r[1], r[2]) == key)
        now = Counter((r[0], r[3]) for r in new if (r[4], r[1], r[2]) == key)
        if was != now:
            status = "added" if not was else "removed" if not now else "changed"
            expected[key] = (sum(was.values()), sum(now.values()), status)
    df = spark.createDataFrame(data, SCHEMA)
    found = versioned.extract_diff(df, ["practice", "a", "b"], before, after, deleted="Deleted")
    assert {
        (r.practice, r.a, r.b): (r.rows_before, r.rows_after, r.status) for r in found.collect()
    } == expected
    with pytest.raises(ValueError):
        versioned.extract_diff(df, ["a"], 2, 2)


def test_a_deleted_key_never_resurfaces(spark):
    rows = [("old", "k", "m", "false", "p", 1), ("gone", "k", "m", "true", "p", 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert versioned.current(df, TABLE).isEmpty()
    assert versioned.as_of(df, TABLE, 1).count() == 1


def test_keyless_and_unversioned(spark):
    df = spark.createDataFrame(histories(3), SCHEMA)
    keyless = Table("t", PRACTICE)
    assert versioned.as_of(df, keyless, 3).count() == df.where("ExtractId <= 3").count()
    assert versioned.as_of(df, keyless).count() == df.count()
    staged = df.drop("ExtractId")
    assert versioned.as_of(staged, TABLE, 1).count() == df.where("Deleted = 'false'").count()


def test_keys_compared_without_case(spark, rows):
    data = [("x", "K", "m", "false", "p", 1), ("y", "k ", "M", "false", "p", 2)]
    df = spark.createDataFrame(data, SCHEMA)
    assert versioned.as_of(df, TABLE).count() == 2
    found = versioned.as_of(df, TABLE, collation="UTF8_LCASE_RTRIM")
    assert rows(found, "v") == [("y",)]


def test_a_hot_key_is_split(small_skew, hot_rows, final_plan):
    """A third of all rows on one key and version: the join splits them over tasks."""
    found = versioned.latest_rows(hot_rows, ["k"])
    assert "skew=true" in final_plan(found)
    assert found.count() == 30000


def test_a_bucketed_history_is_read_without_shuffle(spark):
    data = histories(9)
    path = new_folder(spark, "bucketed")
    save_bucketed(spark.createDataFrame(data, SCHEMA), TABLE, "bucketed_history", 4, path)
    found = versioned.as_of(spark.table("bucketed_history"), TABLE, 4, in_place=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    got = Counter(map(tuple, found.select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()))
    assert got == Counter(alive(state(data, 4)))
    spark.sql("drop table bucketed_history")
    with pytest.raises(ValueError):
        save_bucketed(spark.createDataFrame(data, SCHEMA), Table("t", PRACTICE), "x", 4, path)
