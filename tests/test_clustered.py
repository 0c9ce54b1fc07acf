import random
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from tests.test_history import PLAIN, commit
from tidemark.operators.versioned import as_of
from tidemark.registry import COMMON, PRACTICE, Table
from tidemark.sources import clustered, history as store

TABLE = Table("t", PRACTICE, ("k", "n"), columns=("k", "n", "v", "d"), deleted="d", tenant="v")
KEYS = ["practice", "k", "n"]


def history(spark, n=4000):
    """Keys of three practices in five extracts; a third of the rows have one key in one extract."""
    draw = random.Random(5)
    data = []
    for i in range(n):
        hot = i % 3 == 0
        data.append((
            "hot" if hot else f"{draw.randrange(300):03}", "0" if hot else str(draw.randrange(3)), str(i),
            draw.choice(["false", "false", "true"]), "P0" if hot else f"P{draw.randrange(3)}",
            2 if hot else draw.randrange(1, 6),
        ))
    return spark.createDataFrame(data, TABLE.history_schema)


def files_read(df):
    return {f.rsplit("/", 1)[1] for f in df.inputFiles()}


def test_points_and_prefixes_read_few_files(spark, tmp_path, rows):
    given = history(spark).cache()
    clustered.write_clustered(given, KEYS, str(tmp_path), files=60)
    manifest = spark.read.parquet(f"{tmp_path}/manifest")
    assert manifest.agg(F.sum("Rows")).first()[0] == given.count()
    of_hot = manifest.where("First.k <= 'hot' and Last.k >= 'hot' and First.practice <= 'P0' and Last.practice >= 'P0'")
    assert of_hot.count() > 10, "a hot key fills several files"
    total = manifest.count()
    [a, b, *_, c, d] = given.where("k <> 'hot'").select(*KEYS).distinct().orderBy(*KEYS).collect()
    for wanted in ([tuple(a)], [tuple(b)[:2]], [tuple(c), tuple(d)]):
        found = clustered.read_keys(spark, str(tmp_path), given.schema, KEYS, wanted)
        match = clustered.has_key(given.schema, KEYS, wanted)
        assert rows(found) == rows(given.where(match)) != []
        assert len(files_read(found)) <= max(1, 0.05 * total) + len(wanted) - 1
        assert rows(as_of(found, TABLE, 3)) == rows(as_of(given, TABLE, 3).where(match))
    hot = [("P0", "hot")]
    found = clustered.read_keys(spark, str(tmp_path), given.schema, KEYS, hot)
    assert found.count() == given.where("k = 'hot'").count()


def test_nothing_wanted_nothing_found(spark, tmp_path):
    given = history(spark, 50).unionByName(
        spark.createDataFrame([(None, "1", "x", "false", "P1", 1)], TABLE.history_schema)
    )
    clustered.write_clustered(given, KEYS, str(tmp_path), rows_per_file=20)
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 50
    for wanted in ([], [("P9",)]):
        found = clustered.read_keys(spark, str(tmp_path), given.schema, KEYS, wanted)
        assert found.collect() == [] and found.columns == given.columns
    for wrong in ([()], [("P1", None)], [("P1", "a", "b", "c")]):
        with pytest.raises(ValueError):
            clustered.read_keys(spark, str(tmp_path), given.schema, KEYS, wrong)
    clustered.write_clustered(given.limit(0), KEYS, f"{tmp_path}/empty")
    assert clustered.read_keys(spark, f"{tmp_path}/empty", given.schema, KEYS, [("P1",)]).collect() == []


def test_a_copy_and_what_followed(spark, tmp_path, rows):
    root, given = str(tmp_path), history(spark, 600)
    for extract in range(1, 6):
        part = given.where(F.col("ExtractId") == extract).drop("ExtractId")
        store.write_extract(part, root, TABLE, extract)
        if extract < 5:
            commit(spark, root, extract)
    wanted = [("P1",), ("P2", "010")]
    expected = given.where("ExtractId < 5").where(clustered.has_key(given.schema, KEYS, wanted))
    assert rows(clustered.keyed_history(spark, root, TABLE, wanted)) == rows(expected)
    clustered.cluster_history(spark, root, TABLE, 3, files=10)
    found = clustered.keyed_history(spark, root, TABLE, wanted)
    assert rows(found) == rows(expected)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*\(ExtractId#\d+ > 3\)", plan)
    commit(spark, root, 5)
    assert clustered.keyed_history(spark, root, TABLE, [("P1",)]).where("ExtractId = 5").count() > 0
    with pytest.raises(ValueError):
        clustered.cluster_history(spark, root, TABLE, 6)
    with pytest.raises(ValueError):
        clustered.cluster_history(spark, root, Table("u", COMMON, tenant=None, columns=("a",)), 3)
    assert clustered.keyed_history(spark, root, PLAIN, [("1",)]).isEmpty()


def test_the_query_reads_under_five_percent(spark):
    found = QUERIES["as_of_points"](spark, "/root/testdata/sf0.01")
    assert 0 < len(files_read(found)) < 0.05 * 128
