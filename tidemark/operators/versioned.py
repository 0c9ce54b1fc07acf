"""Tables as of an extract.

A history holds every version of a row with the extract it came in (``ExtractId``). The state as of
extract n is, per key, the rows of the highest version <= n, less those flagged as deleted. Several
rows of one key in one extract are all kept; rows with a null key part never qualify.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.keys import comparable
from tidemark.registry import VERSION, Table


def up_to(history: DataFrame, extract: int | None, version: str = VERSION) -> DataFrame:
    """Versions at or before an extract; a partition filter on a saved history."""
    return history if extract is None else history.where(F.col(version) <= extract)


def newest_versions(
    history: DataFrame, keys: Sequence[str], *, version: str = VERSION
) -> DataFrame:
    """The keys with their newest version: a partial aggregate over the key columns alone."""
    return history.groupBy(*keys).agg(F.max(version).alias(version))


def rows_of_versions(
    history: DataFrame, versions: DataFrame, keys: Sequence[str], *, version: str = VERSION
) -> DataFrame:
    """The rows of the given (key, version) pairs, columns in their order.

    The join is on key *and* version, so that both inputs are plain shuffles: a key holding a large
    share of the rows is then split at run time by the adaptive skew join, where a window would sort
    it inside one task. If the pairs turn out few, the rows are not shuffled at all.
    """
    return history.join(versions, [*keys, version], "left_semi").select(*history.columns)


def latest_rows(
    history: DataFrame,
    keys: Sequence[str],
    extract: int | None = None,
    *,
    version: str = VERSION,
    collation: str | None = None,
) -> DataFrame:
    """All rows of the newest version of each key; null key parts match nothing."""
    rows = up_to(history, extract, version)
    if collation is None:
        newest = newest_versions(rows, keys, version=version)
        return rows_of_versions(rows, newest, keys, version=version)
    newest = rows.groupBy(
        *[comparable(k, collation).alias(f"_key{i}") for i, k in enumerate(keys)]
    ).agg(F.max(version).alias("_newest"))
    same = F.col(version) == F.col("_newest")
    for i, key in enumerate(keys):
        same &= comparable(key, collation) == F.col(f"_key{i}")
    return rows.join(newest, same, "left_semi")


def latest_rows_in_place(
    history: DataFrame,
    keys: Sequence[str],
    extract: int | None = None,
    *,
    version: str = VERSION,
) -> DataFrame:
    """The same rows by a window, for a history already bucketed and sorted on its keys.

    Needs no shuffle there (see ``sources.history.save_bucketed``); each key is ranked in one task.
    """
    rows = up_to(history, extract, version).dropna(subset=list(keys))
    newest_first = Window.partitionBy(*keys).orderBy(F.col(version).desc())
    return rows.withColumn("_rank", F.rank().over(newest_first)).where("_rank = 1").drop("_rank")


def not_deleted(df: DataFrame, column: str | None) -> DataFrame:
    """Rows flagged exactly ``'false'``; null, blank and any other text count as deleted."""
    return df.where(F.col(column) == "false") if column else df


def as_of(
    history: DataFrame,
    table: Table,
    extract: int | None = None,
    *,
    collation: str | None = None,
    in_place: bool = False,
) -> DataFrame:
    """The state of a table as of an extract (``None``: of the newest one).

    An unversioned frame is returned whole, a keyless one up to the extract, both less deleted rows.
    The delete flag is looked at after the version is chosen, so older versions never resurface.
    """
    keys = table.scoped_keys(history.columns)
    if VERSION not in history.columns:
        rows = history
    elif not keys:
        rows = up_to(history, extract)
    elif in_place:
        rows = latest_rows_in_place(history, keys, extract)
    else:
        rows = latest_rows(history, keys, extract, collation=collation)
    return not_deleted(rows, table.deleted)


def current(history: DataFrame, table: Table, **options) -> DataFrame:
    return as_of(history, table, None, **options)


def extract_diff(
    history: DataFrame,
    keys: Sequence[str],
    before: int,
    after: int,
    *,
    deleted: str | None = None,
    ignore: Sequence[str] = (),
    version: str = VERSION,
) -> DataFrame:
    """Keys added, removed or changed between two extracts (``before`` < ``after``).

    A key can only differ if a row of it arrived after the first extract, so the new state is read
    from the later partitions and the old state for the keys found there. The two states of a key
    are compared as bags of rows: identical rows are counted first, then the counts compared. That
    is exact, needs no sorted lists and pre-aggregates copies.
    """
    if before >= after:
        raise ValueError("the first extract must be earlier than the second")
    keys = list(keys)
    payload = [
        c for c in history.columns if c not in keys and c not in ignore and c != version
    ]
    earlier = up_to(history, before, version)
    later = history.where((F.col(version) > before) & (F.col(version) <= after))
    arrived = newest_versions(later, keys, version=version)
    replaced = newest_versions(earlier, keys, version=version).join(
        arrived.select(*keys), keys, "left_semi"
    )
    old = not_deleted(rows_of_versions(earlier, replaced, keys, version=version), deleted)
    new = not_deleted(rows_of_versions(later, arrived, keys, version=version), deleted)
    return compared(old, new, keys, payload)


def compared(
    old: DataFrame, new: DataFrame, keys: Sequence[str], payload: Sequence[str]
) -> DataFrame:
    """The keys whose rows in two states differ as bags, with the rows they have in each."""

    def bag(df: DataFrame, old_side: int, new_side: int) -> DataFrame:
        return df.select(
            *keys, *payload, F.lit(old_side).alias("_old"), F.lit(new_side).alias("_new")
        )

    rows = (
        bag(old, 1, 0)
        .unionByName(bag(new, 0, 1))
        .groupBy(*keys, *payload)
        .agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    )
    per_key = rows.groupBy(*keys).agg(
        F.sum("_old").alias("rows_before"),
        F.sum("_new").alias("rows_after"),
        F.max(F.col("_old") != F.col("_new")).alias("_differs"),
    )
    return (
        per_key.where("_differs")
        .withColumn("status", _diff_status(F.col("rows_before"), F.col("rows_after")))
        .drop("_differs")
    )


def _diff_status(before: Column, after: Column) -> Column:
    return F.when(before == 0, "added").when(after == 0, "removed").otherwise("changed")
