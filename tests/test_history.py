import glob

from pyspark.sql import functions as F

from tidemark.registry import COMMON, PRACTICE, Registry, Table
from tidemark.sources import history as store

TABLE = Table("t", PRACTICE, ("k",), columns=("k", "v"), tenant="v")
PLAIN = Table("c", COMMON, ("k",), tenant=None, columns=("k",))


def rows_of(spark, n, practices):
    return spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.concat(F.lit("P"), (F.col("id") % practices).cast("string")).alias("practice"),
    )


def commit(spark, root, extract):
    fields = store.CONTROL["InstalledExtracts"]
    empty = [None] * (len(fields.split(",")) - 1)
    store.append_control(
        spark.createDataFrame([(extract, *empty)], fields), root, "InstalledExtracts"
    )


def files(root, table, extract):
    return glob.glob(f"{root}/history/{table}/ExtractId={extract}/*.parquet")


def test_only_committed_extracts_are_read(spark, tmp_path):
    root = str(tmp_path)
    assert store.read_history(spark, root, TABLE).isEmpty()
    store.write_extract(rows_of(spark, 10, 3), root, TABLE, 1)
    assert store.read_history(spark, root, TABLE).isEmpty()
    store.write_extract(rows_of(spark, 4, 3), root, TABLE, 1)
    commit(spark, root, 1)
    found = store.read_history(spark, root, TABLE)
    assert found.columns == ["k", "v", "practice", "ExtractId"]
    assert found.count() == 4
    store.write_extract(rows_of(spark, 10, 3), root, TABLE, 2)
    assert store.read_history(spark, root, TABLE).count() == 4
    assert store.read_histories(spark, root, Registry((TABLE, PLAIN)))["c"].isEmpty()


def test_many_small_practices_share_a_file(spark, tmp_path):
    store.write_extract(rows_of(spark, 2000, 200), str(tmp_path), TABLE, 1)
    assert len(files(tmp_path, "t", 1)) <= 2


def test_a_large_practice_is_split(spark, tmp_path, small_skew):
    one = rows_of(spark, 60000, 1)
    store.write_extract(one, str(tmp_path), TABLE, 1)
    assert len(files(tmp_path, "t", 1)) > 4


def test_a_practice_reads_by_statistics(spark, tmp_path):
    root = str(tmp_path)
    store.write_extract(rows_of(spark, 100, 5), root, TABLE, 1)
    commit(spark, root, 1)
    mine = store.read_history(spark, root, TABLE).where("practice = 'P1' and ExtractId <= 1")
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(practice,P1)" in plan
    assert "PartitionFilters: [isnotnull(ExtractId" in plan
    assert mine.count() == 20


def test_snapshots_follow_the_log(spark, tmp_path):
    root = str(tmp_path)
    layout = lambda c: spark.createDataFrame([("t", 0, c)], store.CONTROL["TableLayout"])
    store.write_snapshot(layout("a"), root, "TableLayout", 0)
    store.write_snapshot(layout("b"), root, "TableLayout", 0, 1)
    store.write_snapshot(layout("c"), root, "TableLayout", 1)
    assert store.read_snapshot(spark, root, "TableLayout").first().ColumnName == "b"
    commit(spark, root, 1)
    assert store.read_snapshot(spark, root, "TableLayout").first().ColumnName == "c"


def test_a_batch_replaces_its_earlier_attempt(spark, tmp_path):
    root = str(tmp_path)
    line = lambda r, t: spark.createDataFrame([(r, 1, t)], store.CONTROL["RunText"])
    store.write_batch(line(1, "broken"), root, "RunText", 1)
    store.write_batch(line(1, "good"), root, "RunText", 1)
    store.write_batch(line(2, "next"), root, "RunText", 2)
    found = store.read_control(spark, root, "RunText").orderBy("RunId").collect()
    assert [r.Line for r in found] == ["good", "next"]
