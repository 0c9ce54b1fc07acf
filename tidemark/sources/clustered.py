"""Copies of a history clustered by key, for reads of a few keys.

The files of a copy hold neighbouring ranges of the key, every version of it side by side; a manifest
tells the first and last key of each file. A read opens the files whose range can hold a wanted key, and
in them the row groups that statistics and bloom filters leave. A key with very many rows fills
several files, cut by version and by a hash of the row, and is read by as many tasks.

A copy covers the extracts up to one; what followed is read from the history, filtered by key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.registry import VERSION, Table
from tidemark.sources import history as store
from tidemark.sources.shared import literal

ROWS_PER_FILE = 1_000_000


def write_clustered(
    df: DataFrame,
    keys: Sequence[str],
    path: str,
    *,
    files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write rows clustered by key with the manifest of their files, which is written last.

    ``files`` is worked out from a count of the rows if it is not given. Rows with a null key part are
    left out: no keyed read ever finds them.
    """
    keyed = df.dropna(subset=list(keys))
    if files is None:
        files = max(1, math.ceil(keyed.count() / rows_per_file))
    order = [*keys, *([VERSION] if VERSION in df.columns else [])]
    writer = keyed.repartitionByRange(files, *order, F.xxhash64(*df.columns)).sortWithinPartitions(
        *order
    ).write.mode("overwrite")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(f"{path}/rows")
    ends = F.struct(*keys)
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    manifest = written.groupBy(F.col("_metadata.file_name").alias("File")).agg(
        F.min(ends).alias("First"), F.max(ends).alias("Last"), F.count("*").alias("Rows")
    )
    # One row per file.
    manifest.hint("rebalance").write.mode("overwrite").parquet(f"{path}/manifest")


def files_of(
    spark: SparkSession, path: str, keys: Sequence[str], wanted: Sequence[Sequence]
) -> list[str]:
    """The files that can hold a wanted key: at most a few for each."""
    manifest = spark.read.parquet(f"{path}/manifest")
    types = {f.name: f.dataType for f in manifest.schema["First"].dataType}

    def holds(values: Sequence) -> Column:
        names = keys[: len(values)]
        sought = F.struct(*[F.lit(v).cast(types[k]).alias(k) for k, v in zip(names, values)])
        first, last = (
            F.struct(*[F.col(f"{end}.`{k}`").alias(k) for k in names]) for end in ("First", "Last")
        )
        return (first <= sought) & (sought <= last)

    found = manifest.where(reduce(Column.__or__, map(holds, wanted), F.lit(False))).select("File")
    return [f"{path}/rows/{r.File}" for r in found.toLocalIterator()]


def has_key(schema: T.StructType, keys: Sequence[str], wanted: Sequence[Sequence]) -> Column:
    """True for rows of a wanted key, in terms that reach the scan: equalities of columns and values."""

    def same(values: Sequence) -> Column:
        return reduce(
            Column.__and__,
            [F.col(f"`{k}`") == F.lit(v).cast(schema[k].dataType) for k, v in zip(keys, values)],
        )

    return reduce(Column.__or__, map(same, wanted), F.lit(False))


def _check_wanted(keys: Sequence[str], wanted: Sequence[Sequence]) -> None:
    for values in wanted:
        if not 0 < len(values) <= len(keys) or any(v is None for v in values):
            raise ValueError(f"a wanted key gives one value or more for {', '.join(keys)}: {values}")


def read_keys(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    wanted: Sequence[Sequence],
) -> DataFrame:
    """All versions of the wanted keys from a clustered copy.

    A wanted key may give its leading parts only (a practice, or an order without its lines); it then
    stands for all keys that begin with them. The list is the caller's, a point read; for a large set of
    keys join a frame of them with the history.
    """
    _check_wanted(keys, wanted)
    files = [literal(f) for f in files_of(spark, path, keys, wanted)]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(has_key(schema, keys, wanted))


def clustered_path(root: str, table: str, extract: int) -> str:
    return f"{root.rstrip('/')}/clustered/{table}/UpTo={extract}"


def cluster_history(
    spark: SparkSession, root: str, table: Table, extract: int | None = None, **options
) -> None:
    """Write a clustered copy of all versions up to a committed extract, and list it last."""
    installed = store.last_installed(spark, root) or 0
    extract = installed if extract is None else extract
    keys = table.scoped_keys(table.history_schema.names)
    if not keys:
        raise ValueError(f"{table.name} has no key to cluster by")
    if not 0 < extract <= installed:
        raise ValueError(f"extract {extract} is not installed")
    rows = store.read_history(spark, root, table, installed).where(F.col(VERSION) <= extract)
    write_clustered(rows, keys, clustered_path(root, table.name, extract), **options)
    entry = spark.createDataFrame([(table.name, extract)], store.CONTROL["ClusteredHistories"])
    store.append_control(entry, root, "ClusteredHistories")


def keyed_history(
    spark: SparkSession, root: str, table: Table, wanted: Sequence[Sequence]
) -> DataFrame:
    """All committed versions of the wanted keys: the newest clustered copy and what followed it.

    Keys of practice tables start with the practice. The result goes to ``as_of`` like any history.
    """
    schema = table.history_schema
    keys = table.scoped_keys(schema.names)
    _check_wanted(keys, wanted)
    installed = store.last_installed(spark, root) or 0
    listed = store.read_control(spark, root, "ClusteredHistories").where(
        (F.col("TableName") == table.name) & (F.col("AsOfExtract") <= installed)
    )
    upto = listed.agg(F.max("AsOfExtract")).first()[0] or 0
    history = store.read_history(spark, root, table, installed)
    later = history.where((F.col(VERSION) > upto) & has_key(schema, keys, wanted))
    if not upto:
        return later
    copy = read_keys(spark, clustered_path(root, table.name, upto), schema, keys, wanted)
    return copy.select(*later.columns).unionByName(later)
