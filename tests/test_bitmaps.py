import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bitmaps import (
    BATCHES,
    BITMAPS,
    NUMBERS,
    distinct_counts,
    new_numbers,
    value_bitmaps,
)

VALUES = "ForeignKeyId int, scope string, Value string, Count long, ExtractId int"


def drawn(n=3000):
    draw = random.Random(11)
    return [
        (draw.choice([1, 2]), f"P{draw.randrange(6)}", "hot" if i % 3 == 0 else f"v{draw.randrange(400)}",
         1, draw.randrange(1, 5))
        for i in range(n)
    ]


def test_any_practices_and_extracts(spark, tmp_path):
    """Numbered extract by extract, merged over practices, extracts and both."""
    data = drawn()
    given = spark.createDataFrame(data, VALUES)
    for extract in range(1, 5):
        part = given.where(F.col("ExtractId") == extract)
        known = spark.read.schema(NUMBERS).parquet(f"{tmp_path}/n") if extract > 1 else \
            spark.createDataFrame([], NUMBERS)
        new_numbers(part, known, extract).write.mode("append").parquet(f"{tmp_path}/n")
        numbers = spark.read.schema(NUMBERS).parquet(f"{tmp_path}/n")
        value_bitmaps(part, numbers).write.mode("append").parquet(f"{tmp_path}/b")
    bitmaps = spark.read.schema(BITMAPS).parquet(f"{tmp_path}/b")
    held = [(r.ForeignKeyId, r.Value) for r in numbers.collect()]
    assert sorted(held) == sorted({(k, v) for k, _, v, _, _ in data})
    assert len({r.Number for r in numbers.collect()}) == len(held)
    for name, group in {
        "scope": lambda k, s, e: (k, s), "ExtractId": lambda k, s, e: (k, e), None: lambda k, s, e: (k,),
    }.items():
        expected = {}
        for k, s, v, _, e in data:
            expected.setdefault(group(k, s, e), set()).add(v)
        got = distinct_counts(bitmaps, ["ForeignKeyId", *([name] if name else [])])
        assert {tuple(r)[:-1]: r.DistinctCount for r in got.collect()} == {
            g: len(v) for g, v in expected.items()
        }
    some = bitmaps.where("scope in ('P1', 'P4') and ExtractId < 3")
    [found] = distinct_counts(some, []).collect()
    keys = {1: set(), 2: set()}
    for k, s, v, _, e in data:
        if s in ("P1", "P4") and e < 3:
            keys[k].add(v)
    assert found.DistinctCount == sum(map(len, keys.values()))


def test_nulls_and_nothing(spark):
    known = spark.createDataFrame([], NUMBERS)
    nulls = spark.createDataFrame([(1, None, None, 1, 1), (1, None, "a", 1, 1)], VALUES)
    numbers = new_numbers(nulls, known, 0)
    assert [r.Value for r in numbers.collect()] == ["a"]
    bitmaps = value_bitmaps(nulls, numbers)
    assert [tuple(r) for r in distinct_counts(bitmaps, ["scope"]).collect()] == [(None, 1)]
    assert distinct_counts(bitmaps.limit(0), ["scope"]).collect() == []
    assert distinct_counts(bitmaps.limit(0), []).first().DistinctCount == 0
    for wrong in (-1, BATCHES):
        with pytest.raises(ValueError):
            new_numbers(nulls, known, wrong)


def test_neighbours_fill_few_bitmaps(spark):
    """60,000 values of three practices: two bitmaps a practice would do, some more are made at the cuts."""
    values = spark.range(60000).select(
        F.lit(1).alias("ForeignKeyId"), F.concat(F.lit("P"), F.col("id") % 3).alias("scope"),
        F.sha2(F.col("id").cast("string"), 256).alias("Value"), F.lit(1).alias("ExtractId"),
    )
    numbers = new_numbers(values, spark.createDataFrame([], NUMBERS), 0)
    bitmaps = value_bitmaps(values, numbers)
    assert bitmaps.count() <= 12
    assert {r.DistinctCount for r in distinct_counts(bitmaps, ["scope"]).collect()} == {20000}
