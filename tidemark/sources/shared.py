"""The folder all executors can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one in local mode only."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{SETTING} is not set: no folder that all executors share is known")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext.getCheckpointDir()


def literal(path: str) -> str:
    """A listed path as a reader takes it: readers would look for patterns in it."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that goes when the session's JVM ends."""
    folder = new_folder(spark, name)
    delete_at_end(spark, folder)
    return folder


def written_once(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read from there, as often as needed.

    The folder goes when the session's JVM ends; no executor has to keep anything.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def written_by(df: DataFrame, column: str, name: str) -> DataFrame:
    """The same with a folder per value of a column: a filter on it opens the folders it asks for, no other."""
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    df.write.partitionBy(column).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder).select(*df.columns)


def delete_at_end(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
