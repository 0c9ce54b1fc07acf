import pytest
from pyspark.sql import functions as F

from tidemark.operators import results
from tidemark.registry import COMMON, PRACTICE, ForeignKey, Registry, Table

REGISTRY = Registry(
    (Table("c", COMMON, ("k",), tenant=None), Table("p", PRACTICE, ("k",))),
    (
        ForeignKey(1, "p", "a", "c", "k"),
        ForeignKey(2, "p", "b", "c", "k"),
        ForeignKey(3, "p", "d", "c", "k"),
        ForeignKey(4, "p", "e", "c", "k"),
    ),
)


@pytest.fixture
def keys(spark):
    return REGISTRY.foreign_key_frame(spark)


@pytest.fixture
def errors(spark):
    return spark.createDataFrame(
        [(1, 1, 5, 3), (1, 2, 7, 7), (2, 1, 8, 3), (2, 3, 2, 1), (3, 2, 1, 1)],
        "RunId int, ForeignKeyId int, Count long, DistinctCount long",
    )


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [(1, "S1", 3, 1), (2, "S1", 4, 2), (3, "S2", 4, 2)],
        "RunId int, PracticeDBName string, ExtractId int, RunGroupId int",
    )


@pytest.fixture
def practices(spark):
    return spark.createDataFrame(
        [("S1", 11, "The long name", 2), ("S2", 12, "Another", 1)],
        "PracticeDBName string, CDB int, PracticeName string, StartExtractId int",
    )


def test_change_texts(errors, keys, rows):
    found = results.fk_result(errors, keys, 2, 1)
    assert rows(found, "FromColumn", "Count", "DistinctCount") == [
        ("a", "8  (+3)", "3"), ("b", "0  (-7)", "0  (-7)"), ("d", "2  (+2)", "1  (+1)"),
    ]
    alone = results.fk_result(errors, keys, 2)
    assert rows(alone, "FromColumn", "Count") == [("a", "8"), ("b", "0"), ("d", "2")]
    assert alone.columns == [*results.FK_COLUMNS, "Count", "DistinctCount"]


def test_columns_in_run_order(errors, keys, runs, practices):
    selected = results.select_runs(runs, practices, group=2, comparison_group=1)
    report = results.fk_results(errors, keys, selected)
    assert report.columns[5:] == ["CDB12-Ext4", "CDB11-Ext4"]
    assert [tuple(r)[2:3] + tuple(r)[5:] for r in report.collect()] == [
        ("a", "0", "8  (+3)"), ("b", "1", "0  (-7)"), ("d", "0", "2  (+2)"),
    ]


def test_one_practice_by_name(errors, keys, runs, practices):
    selected = results.select_runs(runs, practices, cdb=11, use_name=True)
    report = results.fk_results(errors, keys, selected, distinct=True)
    assert report.columns[5:] == ["The long n-Ext3", "The long n-Ext4"]
    assert [tuple(r)[5:] for r in report.collect()] == [("3", "3"), ("7", "0"), ("0", "1")]


def test_repeated_headers_get_the_run(errors, keys, runs, practices, spark):
    again = runs.union(spark.createDataFrame([(4, "S1", 4, 2)], runs.schema))
    selected = results.select_runs(again, practices, group=2)
    report = results.fk_results(errors, keys, selected)
    assert report.columns[5:] == ["CDB12-Ext4", "CDB11-Ext4 #2", "CDB11-Ext4 #4"]
    twice = results.select_runs(again, practices, group=1, comparison_group=2)
    assert results.fk_results(errors, keys, twice).columns[5:] == [
        "CDB11-Ext3 #1 #2", "CDB11-Ext3 #1 #4",
    ]


def test_nothing_selected(errors, keys, runs, practices):
    selected = results.select_runs(runs, practices, cdb=99)
    assert results.fk_results(errors, keys, selected).count() == 3
    with pytest.raises(ValueError):
        results.select_runs(runs, practices)


def test_twenty_thousand_runs(keys, spark):
    """The plan does not know how many runs there are; every cell is where its run is."""
    n = 20000
    selected = spark.range(1, n + 1, 1, 8).select(
        (F.col("id") + n).cast("int").alias("RunId"),
        F.when(F.col("id") % 2 == 0, F.col("id")).cast("int").alias("ComparisonRunId"),
        F.concat(F.lit("run "), F.col("id")).alias("Header"), F.col("id").cast("int").alias("OrderBy"),
    )
    errors = spark.range(1, 2 * n + 1, 1, 8).select(
        F.col("id").cast("int").alias("RunId"), F.explode(F.array(F.lit(1), F.lit(2))).alias("ForeignKeyId"),
        (F.col("id") % 7).alias("Count"), F.lit(1).alias("DistinctCount"),
    ).where("ForeignKeyId = 1 or RunId % 5 = 0")
    listed = results.fk_results_listed(errors, keys, selected)
    cells = {r.FromColumn: r.Cells for r in listed.collect()}

    def cell(key, i):
        now, then = ((run % 7 if key == 1 or run % 5 == 0 else 0) for run in (i + n, i))
        change = now - then
        return str(now) + (f"  ({change:+d})" if i % 2 == 0 and change else "")

    assert cells == {
        name: [cell(key, i) for i in range(1, n + 1)] for key, name in ((1, "a"), (2, "b"))
    }
    lines = [r.Line.split("\t") for r in results.report_text(listed, selected).orderBy("LineId").collect()]
    assert [len(line) for line in lines] == [n + 5] * 3
    assert lines[0][:7] == [*results.FK_COLUMNS, "run 1", "run 2"] and lines[2][5:] == cells["b"]


def test_listed_without_errors_or_runs(errors, keys, runs, practices, rows):
    none = results.select_runs(runs, practices, cdb=99)
    listed = results.fk_results_listed(errors, keys, none)
    assert rows(listed, "FromColumn", "Cells") == [("a", []), ("b", []), ("d", [])]
    assert results.fk_results_listed(errors.limit(0), keys, none).collect() == []
    [header, *_] = results.report_text(listed, none).orderBy("LineId").collect()
    assert header.Line.split("\t") == results.FK_COLUMNS
