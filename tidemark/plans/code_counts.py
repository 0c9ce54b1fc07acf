"""Code counts of a store, kept up to date extract by extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import care_records
from tidemark.operators.analytics import text_date
from tidemark.operators.code_state import CODE_COUNTS, code_counts_after
from tidemark.registry import VERSION, Registry
from tidemark.sources import history as store


def update_code_counts(
    spark: SparkSession,
    root: str,
    table: str,
    registry: Registry = care_records.CARE_RECORDS,
    code: str = "CodeId",
    date: str | Column | None = None,
) -> list[int]:
    """Count the installed extracts that are not counted yet, one after the other; returns their numbers.

    The counts as of each extract are a batch of their own that is written whole and listed last, so
    a run that stops goes on where it stopped, and one that is repeated counts nothing twice. ``date`` is a text
    column read as a date, or an expression (``EffectiveDate`` if not given).
    """
    about = store.read_layout(spark, root, registry).table(table)
    when = text_date("EffectiveDate" if date is None else date) if not isinstance(date, Column) else date
    counted = _counted(spark, root, table).agg(F.max(VERSION)).first()[0] or 0
    installed = store.read_control(spark, root, "InstalledExtracts").where(F.col(VERSION) > counted)
    done = []
    for extract in sorted(r[VERSION] for r in installed.select(VERSION).collect()):
        state = _as_of(spark, root, table, counted)
        history = store.recent_history(spark, root, about, extract - 1)
        arrived = store.read_history(spark, root, about).where(F.col(VERSION) == extract)
        counts = code_counts_after(state, history.unionByName(arrived), about, extract, code, when)
        rows = counts.select(F.lit(table).alias("TableName"), "*")
        store.write_batch(rows, root, "CodeCounts", f"{table}-{extract}")
        line = spark.createDataFrame([(table, extract)], store.CONTROL["CountedExtracts"])
        store.write_batch(line, root, "CountedExtracts", f"{table}-{extract}")
        counted = extract
        done.append(extract)
    return done


def stored_code_counts(
    spark: SparkSession, root: str, table: str, extract: int | None = None
) -> DataFrame:
    """The counts as of an extract (``None``: the last one counted), as ``CODE_COUNTS``."""
    counted = _counted(spark, root, table)
    if extract is not None:
        counted = counted.where(F.col(VERSION) <= extract)
    return _as_of(spark, root, table, counted.agg(F.max(VERSION)).first()[0] or 0)


def _counted(spark: SparkSession, root: str, table: str) -> DataFrame:
    return store.read_control(spark, root, "CountedExtracts").where(F.col("TableName") == table)


def _as_of(spark: SparkSession, root: str, table: str, extract: int) -> DataFrame:
    if not extract:
        return spark.createDataFrame([], CODE_COUNTS)
    return store.read_batch(spark, root, "CodeCounts", f"{table}-{extract}").drop("TableName")
