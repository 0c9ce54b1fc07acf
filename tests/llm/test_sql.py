"""Queries with a SQL counterpart: whole small tables, edge cases, an empty table."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

GIVEN = "/root/testdata/sf0.001"
#: Those that read documents.
OF_DOCUMENTS = sorted(ORACLE.keys() - {"op13_warc"})


def compare(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {table} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    found = con.execute(ORACLE[name])
    given = [d[0] for d in found.description]
    assert sorted(given) == columns
    want = sorted((tuple(r[given.index(c)] for c in columns) for r in found.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want
    return want


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_given_tables(spark, name):
    assert compare(spark, GIVEN, name)


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_edge_cases(spark, table, edge_rows, prose, name, tmp_path):
    rows = edge_rows + [
        (20, "a b c a b c x\nline\nline\n \nline", "en", None),
        (21, " ".join(prose(80, 1)) + " %%% $ <|>", "en", "src1"),
        (22, " ".join(prose(20, 2) * 4), "de", None),
        (-23, "É İ ß 😀  x\r\x0b\x0cy under the MIT license, cc-by-nc", "fr", "z"),
    ]
    docs = table(rows).withColumns({c: F.lit("x") for c in ("size", "key", "target", "kept", "f", "level", "part", "row")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = compare(spark, str(tmp_path), name)
    assert len(found) == len(rows) or name == "op11_source_divergence"


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_empty_table(spark, table, name, tmp_path):
    table([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert compare(spark, str(tmp_path), name) == []


def test_pages(spark, tmp_path):
    rows = [
        (5, "u5", "same"), (3, "u3", "same"), (9, None, "same"), (3, "other", "same"), (None, "u", "same"),
        (1, "é\n", None), (2, "x", ""), (None, "a", "alone"), (None, "b", "alone"), (7, "u7", "ß" * 70000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.withColumns({c: F.lit("x") for c in ("id", "same", "first", "payload", "refers", "member")}).write.parquet(f"{tmp_path}/pages.parquet")
    assert len(compare(spark, str(tmp_path), "op13_warc")) == len(rows)


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert compare(spark, str(tmp_path), "op13_warc") == []
