"""How much of the tables the queries over many extracts read, on rows made here."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import queries
from tidemark.operators import bitmaps, code_state
from tidemark.operators.code_state import CODE_COUNTS, code_counts_after
from tidemark.registry import PRACTICE, Table
from tidemark.sources.shared import written_by, written_once

DAY = datetime(2020, 1, 1)


@pytest.fixture
def folder(spark, tmp_path):
    """Two nations; line items of seven years, a part's sent again every year, one without a date."""
    years = [datetime(1995 + i, 6, 1) for i in range(7)]
    lines = [(10 * i + n, p, n, 1, float(i), 1.0, "N", "O", d)
             for i, d in enumerate([*years, None]) for n in (0, 1) for p in (1, 2, 3)]
    schemas = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp", lines),
        "supplier": ("s_suppkey long, s_nationkey int, s_acctbal double", [(0, 0, 1.0), (1, 1, -1.0)]),
        "nation": ("n_nationkey int, n_regionkey int", [(0, 0), (1, 4)]),
        "customer": ("c_custkey long, c_nationkey int, c_acctbal double", [(0, 0, 1.0), (1, 1, 1.0)]),
        "part": ("p_partkey long, p_size int", [(1, 1), (2, 50)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp",
                   [(10 * i + n, n, d) for i, d in enumerate(years) for n in (0, 1)]),
        "events": ("event_id long, user_id long, ts timestamp", [(1, 0, years[0]), (2, 1, years[1])]),
    }
    for name, (schema, rows) in schemas.items():
        df = spark.createDataFrame(rows, schema)
        if name == "lineitem":
            df = df.withColumns({"l_discount": F.lit(0.0), "l_tax": F.lit(0.0)})
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_differences_are_not_read_together_by_one_task(spark, folder):
    found = queries.diff_of_intervals(spark, folder)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    assert {(r.before, r.after) for r in rows} == set(queries.SPANS)
    assert {(r.status, r.rows_before, r.rows_after) for r in rows} == {("changed", 2, 2)}


def test_an_extract_opens_its_own_folder(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, None)], "k int, v string, ExtractId int")
    kept = written_by(df, "ExtractId", "kept")
    assert kept.schema == df.schema and rows(kept) == rows(df)
    assert kept.where("ExtractId = 2").inputFiles() and kept.columns == df.columns
    read = kept.where("ExtractId = 2").select("_metadata.file_path").collect()
    assert [("/ExtractId=2/" in r[0]) for r in read] == [True]
    assert written_by(df.limit(0), "ExtractId", "none").where("ExtractId = 1").collect() == []


@pytest.mark.parametrize("name,seen", [("code_counts_standing", "history"), ("fk_by_extract", "tables")])
def test_the_operators_get_histories_written_by_extract(spark, folder, monkeypatch, name, seen):
    given = []
    if name == "code_counts_standing":
        whole = code_state.code_counts_after
        monkeypatch.setattr(queries.code_state, "code_counts_after",
                            lambda state, history, *a: given.append(history) or whole(state, history, *a))
    else:
        whole = queries.standing.arriving_orphans
        monkeypatch.setattr(queries.standing, "arriving_orphans",
                            lambda tables, *a: given.extend(tables.values()) or whole(tables, *a))
    assert queries.QUERIES[name](spark, folder).count() > 0
    for df in given:
        read = df.where("ExtractId = 3") if seen == "history" else df
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(ExtractId" in plan and "Join" not in plan


def test_no_lost_date_no_second_look(spark, monkeypatch):
    """Later rows have later dates: the history is not searched; where a date is lost it is."""
    schema = "k string, CodeId string, EffectiveDate timestamp_ntz, Deleted string, practice string, ExtractId int"
    table = Table("t", PRACTICE, ("k",), deleted="Deleted")
    later = datetime(2021, 1, 1)
    df = spark.createDataFrame(
        [("1", "a", DAY, "false", "P", 1), ("2", "a", DAY, "false", "P", 1), ("1", "a", later, "false", "P", 2),
         ("1", "b", DAY, "false", "P", 3)], schema)
    searched = []
    whole = code_state._latest_dates
    monkeypatch.setattr(code_state, "_latest_dates", lambda *a: searched.append(1) or whole(*a))
    state, found = spark.createDataFrame([], CODE_COUNTS), []
    for extract in (1, 2, 3):
        rows = code_counts_after(state, df, table, extract).collect()
        state = spark.createDataFrame(
            [(r.practice, r.CodeId, r.MostRecentDate, r.CodeCount) for r in rows], CODE_COUNTS)
        found.append((len(searched), sorted((r.CodeId, r.MostRecentDate, r.CodeCount) for r in rows)))
    assert found == [(0, [("a", DAY, 2)]), (0, [("a", later, 2)]), (1, [("a", DAY, 1), ("b", DAY, 1)])]


def test_bitmaps_are_made_where_their_numbers_are(spark, final_plan):
    """No bitmap goes through a shuffle: every exchange is below both aggregates."""
    values = spark.range(2000).select(
        (F.col("id") % 2).cast("int").alias("ForeignKeyId"), F.concat(F.lit("P"), F.col("id") % 3).alias("scope"),
        F.col("id").cast("string").alias("Value"), (F.col("id") % 5).cast("int").alias("ExtractId"),
    )
    numbers = values.select("ForeignKeyId", "Value", F.col("Value").cast("long").alias("Number"))
    numbers = written_once(numbers, "numbers")
    made = bitmaps.value_bitmaps(values, numbers)
    plan = final_plan(made).split("== Initial Plan ==")[0]
    assert "bitmap_construct_agg" in plan and made.columns == ["ForeignKeyId", "scope", "ExtractId", "Bucket", "Bitmap"]
    assert plan.rindex("bitmap_construct_agg") < plan.index("Exchange")
