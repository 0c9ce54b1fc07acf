import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import extracts as x
from tests.test_integrity import REGISTRY, brute, data, frames
from tidemark.care_records import CARE_RECORDS
from tidemark.operators.standing import (
    KEYS,
    ORPHANS,
    arriving_keys,
    arriving_orphans,
    standing_values,
)
from tidemark.plans import validate
from tidemark.plans.install import install_all
from tidemark.plans.validate import ValidationError, check_new_extracts, validate_practices
from tidemark.sources import history as store


@pytest.mark.parametrize("collation,same", [
    (None, lambda v: v), ("UTF8_LCASE_RTRIM", lambda v: v.lower().rstrip(" ")),
])
def test_after_each_extract_as_if_all_were_read(spark, collation, same):
    tables = data(6)
    given = frames(spark, *tables)
    known, orphans = spark.createDataFrame([], KEYS), spark.createDataFrame([], ORPHANS)
    for extract in range(1, 6):
        rows = {name: df.where(F.col("ExtractId") == extract) for name, df in given.items()}
        new = arriving_keys(rows, REGISTRY, known, extract, collation).collect()
        known = known.unionByName(spark.createDataFrame(new, KEYS))
        found = arriving_orphans(rows, REGISTRY, known, extract, collation).collect()
        orphans = orphans.unionByName(spark.createDataFrame(found, ORPHANS))
        values = standing_values(orphans, extract, collation)
        got = Counter({
            (r.ForeignKeyId, r.scope, same(r.Value)): r.Count for r in values.collect()
        })
        assert got == brute(*tables, bound=extract, same=same)
    held = [(r.Target, r.scope, same(r.Value)) for r in known.collect()]
    assert len(held) == len(set(held)), "a key is stored once"


def test_nulls_blanks_and_empty_tables(spark):
    given = frames(spark, [(None, None, None, 1)], [(" ", "v", None, 1), ("w", None, "P", 1)], [])
    known, none = spark.createDataFrame([], KEYS), spark.createDataFrame([], ORPHANS)
    assert arriving_keys(given, REGISTRY, known, 1).collect() == []
    found = arriving_orphans(given, REGISTRY, known, 1).collect()
    assert sorted((r.ForeignKeyId, r.scope, r.Value) for r in found) == [(10, "P", "w"), (20, None, "v")]
    assert standing_values(none, 3).collect() == []


def test_a_value_of_a_third_of_the_rows_is_counted_before_it_meets_the_index(spark, final_plan):
    child = spark.range(30000).select(
        F.when(F.col("id") < 10000, "hot").otherwise(F.col("id").cast("string")).alias("p"),
        F.lit(None).cast("string").alias("c"), F.lit("P").alias("practice"), F.lit(1).alias("ExtractId"),
    )
    given = {**frames(spark, [("a", None, "P", 1)], [], []), "child": child}
    found = arriving_orphans(given, REGISTRY, spark.createDataFrame([("parent.k", "P", "a", 0)], KEYS), 1)
    assert {r.Value: r.Count for r in found.collect()}["hot"] == 10000
    plan = final_plan(found)
    assert plan.index("partial_count") > plan.index("Join"), "above in the plan text means later"


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    base = tmp_path_factory.mktemp("standing")
    root, folder = str(base / "store"), str(base / "in")
    x.write_extract(f"{folder}/e1", "1-100", "20170101020000", x.bulk())
    x.write_extract(f"{folder}/e2", "101-150", "20170108020000", x.delta(), line_end="\n")
    x.write_extract(f"{folder}/e3", "1-40", "20170115020000", x.delta_with_new_practice(), guid=x.GUID.lower())
    return root, folder


def outcome(run):
    errors = sorted((r.RunId - run.runs.agg(F.min("RunId")).first()[0], r.ForeignKeyId, r.Count, r.DistinctCount) for r in run.errors.collect())
    return errors, sorted(r.Line for r in run.lines.collect() if "Run" not in r.Line)


def test_store(spark, folders, monkeypatch):
    """After each install the standing outcome is that of the whole history; a broken check is done again."""
    root, folder = folders
    for extract in (1, 2, 3):
        install_all(spark, root, f"{folder}/e{extract}")
        if extract == 2:
            write = store.write_batch

            def broken(df, at, name, batch):
                write(df, at, name, batch)
                if name == "StandingOrphans":
                    raise RuntimeError("lost")

            monkeypatch.setattr(store, "write_batch", broken)
            with pytest.raises(RuntimeError):
                check_new_extracts(spark, root)
            monkeypatch.setattr(store, "write_batch", write)
            assert validate.standing_orphans(spark, root).where("ExtractId = 2").count() == 0
        assert check_new_extracts(spark, root) == [extract]
        assert check_new_extracts(spark, root) == []
    whole, standing = validate_practices(spark, root), validate_practices(spark, root, mode="standing")
    assert whole.errors.count() > 0
    assert outcome(standing)[0] == outcome(whole)[0]
    early, before = (validate_practices(spark, root, extract=2, bound=2, mode=m) for m in ("history", "standing"))
    assert outcome(early)[0] == outcome(before)[0]
    one, same = (validate_practices(spark, root, practice="Practice102", mode=m) for m in ("history", "standing"))
    assert outcome(one)[0] == outcome(same)[0]
    with pytest.raises(ValidationError):
        check_new_extracts(spark, root, collation="UTF8_LCASE")


def test_one_partition_of_the_children_is_read(spark, folders):
    root, _ = folders
    registry = store.read_layout(spark, root, CARE_RECORDS)
    rows = {n: df.where("ExtractId = 3") for n, df in store.read_histories(spark, root, registry).items()}
    found = arriving_orphans(rows, registry, store.read_control(spark, root, "KeyIndex"), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "/history/" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^]]*\(ExtractId#\d+ = 3\)", line) for line in scans)
