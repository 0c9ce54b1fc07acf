from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_versioned import SCHEMA, TABLE, alive, histories, state
from tidemark.operators import versioned
from tidemark.operators.intervals import as_of_intervals, diff_of_intervals, with_validity

KEYS = ["practice", "a", "b"]


def test_every_state_and_every_difference(spark):
    """Random versions with ties, copies, null key parts and odd delete flags."""
    data = histories(11, 250)
    df = spark.createDataFrame(data, SCHEMA)
    made = with_validity(df, KEYS).cache()
    for n in range(1, 7):
        got = Counter(tuple(r) for r in as_of_intervals(made, n, TABLE.deleted).collect())
        assert got == Counter(alive(state(data, n)))
    for a, b in [(1, 2), (1, 6), (2, 5), (3, 4), (5, 6)]:
        by_filter = diff_of_intervals(made, KEYS, a, b, deleted=TABLE.deleted)
        afresh = versioned.extract_diff(df, KEYS, a, b, deleted=TABLE.deleted)
        assert sorted(map(repr, by_filter.collect())) == sorted(map(repr, afresh.collect()))
    made.unpersist()
    with pytest.raises(ValueError, match="earlier"):
        diff_of_intervals(made, KEYS, 3, 3)


def test_no_rows_and_rows_that_stay(spark, rows):
    none = spark.createDataFrame([], SCHEMA)
    assert with_validity(none, KEYS).collect() == []
    df = spark.createDataFrame([("x", "k", "m", "false", "P", 1)] * 2, SCHEMA)
    assert rows(with_validity(df, KEYS), "ExtractId", "ReplacedIn") == [(1, None)] * 2
    assert diff_of_intervals(with_validity(df, KEYS), KEYS, 1, 2).collect() == []


def test_a_key_of_a_third_of_the_rows_is_split(spark, hot_rows, small_skew, final_plan):
    made = with_validity(hot_rows, ["k"])
    assert "skew=true" in final_plan(made)
    assert made.where(F.col("k") == -1).count() == 10000
