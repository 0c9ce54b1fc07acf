"""Counts across practices."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.versioned import as_of, current
from tidemark.registry import TENANT, Table

#: Branches that one plan may have.
FEW_PRACTICES = 50

DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def practice_counts(practices: DataFrame, history: DataFrame, table: Table) -> DataFrame:
    """Current rows of a table per configured practice, practices without rows included."""
    counts = current(history, table).groupBy(TENANT).agg(F.count("*").alias("_n"))
    return (
        practices.join(counts, F.col("PracticeDBName") == F.col(TENANT), "left")
        .select(
            "PracticeName",
            F.col("PracticeDBName").alias("DatabaseName"),
            F.coalesce("_n", F.lit(0)).alias("PatientCount"),
        )
        .orderBy(F.col("PatientCount").desc(), "DatabaseName")
    )


def text_date(value: str | Column) -> Column:
    """A date written as text, null if it is none of the known forms."""
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in DATE_FORMATS]).cast(
        "timestamp_ntz"
    )


def code_counts_by_practice(
    rows: DataFrame, code: str = "CodeId", date: str | Column = "EffectiveDate"
) -> DataFrame:
    """Uses and latest use of every code per practice; rows without a code are left out.

    :func:`code_rows_left_out` counts those, and the dates that could not be read.
    """
    when = F.col(date) if isinstance(date, str) else date
    return (
        rows.where(F.col(code).isNotNull())
        .groupBy(TENANT, F.col(code).alias("CodeId"))
        .agg(F.max(when).alias("MostRecentDate"), F.count("*").alias("CodeCount"))
    )


def total_code_counts(by_practice: DataFrame) -> DataFrame:
    """Uses and latest use of every code over all practices."""
    return by_practice.groupBy("CodeId").agg(
        F.max("MostRecentDate").alias("MostRecentDate"), F.sum("CodeCount").alias("CodeCount")
    )


def fold_code_counts(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Add the counts of a batch to a running total: counts add up, the later date wins."""
    columns = ["CodeId", "MostRecentDate", "CodeCount"]
    return total_code_counts(state.select(*columns).unionByName(batch.select(*columns)))


def refresh_code_counts(
    state: DataFrame, batch: DataFrame, practices: DataFrame
) -> DataFrame:
    """Per-practice counts with those of the practices recounted replaced, so a rerun counts once.

    ``practices`` (``practice``) are the practices that were counted again, whether or not anything
    was found: a practice whose rows are all gone has no counts any more.
    """
    kept = state.join(practices.select(TENANT).distinct(), TENANT, "left_anti")
    return kept.unionByName(batch)


def code_rows_left_out(
    rows: DataFrame, code: str = "CodeId", date: str = "EffectiveDate"
) -> DataFrame:
    """Per practice, the rows that code counts leave out or take without a date.

    ``NoCode`` rows are in no count; rows with an ``UnreadDate`` (text that is no known form) are
    counted, but their date is not looked at.
    """
    unread = F.col(date).isNotNull() & text_date(date).isNull()
    return rows.groupBy(TENANT).agg(
        F.count("*").alias("AllRows"),
        F.count_if(F.col(code).isNull()).alias("NoCode"),
        F.count_if(F.col(code).isNotNull() & unread).alias("UnreadDate"),
    )


def describe_codes(
    counts: DataFrame,
    codes: DataFrame,
    table: Table,
    *,
    state: str = "history",
    about: Sequence[str] = ("Term", "ReadTermId", "SnomedCTConceptId", "SnomedCTDescriptionId"),
) -> DataFrame:
    """Counts with the dictionary entry of each code.

    ``history`` joins every version of the dictionary, so a code sent twice shows twice;
    ``current`` joins its current state.
    """
    if state not in ("history", "current"):
        raise ValueError("state is 'history' or 'current'")
    key = table.keys[0]
    entries = codes if state == "history" else as_of(codes, table)
    entries = entries.select(F.col(key).alias("CodeId"), *about)
    return (
        counts.join(entries, "CodeId")
        .select("CodeId", *about, "CodeCount", "MostRecentDate")
        .orderBy(F.col("CodeCount").desc(), "CodeId")
    )


def across_practices(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run one query over tables of all practices; group by ``practice`` to get a row for each.

    Tables are named in braces: ``select practice, count(*) from {patients} group by practice``.
    """
    return spark.sql(query, **tables)


def by_practice(
    spark: SparkSession, query: str, practices: DataFrame, tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Run a query that knows nothing of practices for every one of them, as one plan.

    ``practices`` (``practice``) may be any number; ``query`` names tables in braces, where a table may stand.
    Each name stands for the rows of the practice at hand, without their practice column; tables that have
    none are whole for everyone. The query is joined to the practices as a lateral subquery, which Spark
    turns into grouping and joining by practice: there is no plan, job or file per practice, and a
    practice with a large share of the rows is split like any other key. The result is what each
    practice alone would give, with the practice first: also a count of 0 where it has no rows. Tables
    with practices inside of a subquery expression (``where v = (select ...)``) or on the optional side of
    an outer join are refused by Spark, which cannot turn those around: :func:`for_each_practice` takes them.
    """
    own = {}
    for name, df in tables.items():
        columns = [f"`{c.replace('`', '``')}`" for c in df.columns if c != TENANT]
        own[name] = "{" + name + "}"
        if TENANT in df.columns:
            of_practice = f"where `{TENANT}` = _practices.`{TENANT}`"
            own[name] = f"(select {', '.join(columns)} from {{{name}}} {of_practice})"
    inner = re.sub(r"\{(\w+)\}", lambda found: own[found[1]], query)
    named = practices.select(TENANT).distinct()
    return spark.sql(
        f"select _practices.`{TENANT}`, _own.* from {{_named}} _practices, lateral ({inner}) _own",
        _named=named,
        **tables,
    )


def for_each_practice(
    spark: SparkSession,
    query: str,
    practices: Sequence[str],
    tables: Mapping[str, DataFrame],
    limit: int = FEW_PRACTICES,
) -> DataFrame:
    """Run a query that knows nothing of practices against each practice's own rows.

    The results come back as one frame with the practice added. Each branch filters its practice,
    which file statistics make cheap, but the plan grows with the list: longer lists than ``limit``
    are refused. There, group by practice with :func:`across_practices`, or write practice by practice
    with :func:`store_for_each_practice`.
    """
    practices = sorted(set(practices))
    if not practices:
        raise ValueError("no practices given")
    if len(practices) > limit:
        raise ValueError(
            f"{len(practices)} practices are too many for one plan; use across_practices or "
            "store_for_each_practice"
        )
    return reduce(
        DataFrame.unionByName, [_own_result(spark, query, p, tables) for p in practices]
    )


def store_for_each_practice(
    spark: SparkSession,
    query: str,
    practices: Iterable[str],
    tables: Mapping[str, DataFrame],
    path: str,
) -> DataFrame:
    """The same results written practice by practice to one folder, and read from there.

    Each practice is a job of its own, so no plan grows with the list; a rerun replaces what an earlier
    attempt wrote for a practice.
    """
    schema = None
    for practice in practices:
        result = _own_result(spark, query, practice, tables)
        schema = result.schema
        result.drop(TENANT).write.mode("overwrite").parquet(f"{path}/{TENANT}={practice}")
    if schema is None:
        raise ValueError("no practices given")
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _own_result(
    spark: SparkSession, query: str, practice: str, tables: Mapping[str, DataFrame]
) -> DataFrame:
    own = {
        name: df.where(F.col(TENANT) == practice).drop(TENANT) if TENANT in df.columns else df
        for name, df in tables.items()
    }
    result = spark.sql(query, **own)
    return result.select(F.lit(practice).alias(TENANT), *result.columns)
