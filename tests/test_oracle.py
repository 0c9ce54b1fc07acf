"""Every registered query against the same question in SQL, over whole tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def bag(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    expected = database.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    records = [tuple(r) for r in df.collect()]
    assert bag(df.columns, records) == bag(expected.columns, expected.fetchall())


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
