import os
import sys

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame."""

    def of(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return of


@pytest.fixture
def small_skew(spark):
    """Adaptive execution with thresholds that fit test data."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def final_plan():
    def of(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return of


@pytest.fixture
def hot_rows(spark):
    """30,000 rows, a third of them with one key in one extract."""
    hot = F.col("id") < 10000
    wide = F.concat_ws("", *[F.sha2((F.col("id") * 7 + i).cast("string"), 256) for i in range(8)])
    return spark.range(0, 30000, 1, 8).select(
        F.when(hot, -1).otherwise(F.col("id")).alias("k"),
        F.when(hot, 2).otherwise(1 + F.col("id") % 2).cast("int").alias("ExtractId"),
        wide.alias("v"),
    )
