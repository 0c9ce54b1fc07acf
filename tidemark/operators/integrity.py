"""Foreign-key checks on raw history.

A child value is an orphan if no parent row with that value arrived at or before the child row.
Deletions do not matter on either side; null and blank values are never orphans. Values of practice
tables are sought in the same practice only if the parent is a practice table too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.keys import comparable, is_filled
from tidemark.operators.versioned import as_of, up_to
from tidemark.registry import PRACTICE, TENANT, VERSION, ForeignKey, Registry
from tidemark.sources.shared import written_once

EVERYWHERE = "*"
SAMPLE_SIZE = 10


def orphans(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    key: str,
    *,
    by: Sequence[str] = (),
    version: str | None = VERSION,
    collation: str | None = None,
) -> DataFrame:
    """The child rows whose value has no parent row, or none that arrived in time.

    ``by`` names scope columns both sides share; ``version=None`` ignores the order of arrival. The
    distinct (scope, value, version) combinations of the child are checked against the earliest
    version of each parent key, so neither a value that many rows carry nor a parent sent many times
    weighs on the join. The rows are then picked by their combination: without a shuffle if orphans
    are few, split at run time by the adaptive skew join if one value has very many.
    """
    filled = child.where(is_filled(column))
    arrival = version or (VERSION if VERSION in child.columns else None)
    mine = {f"_by{i}": F.col(c) for i, c in enumerate(by)}
    mine["_value"] = comparable(F.col(column), collation)
    if arrival:
        mine["_arrival"] = F.col(arrival)
    theirs = [F.col(c).alias(f"_in{i}") for i, c in enumerate(by)]
    first = (
        parent.where(F.col(key).isNotNull())
        .groupBy(*theirs, comparable(key, collation).alias("_key"))
        .agg(F.min(version or F.lit(0)).alias("_first"))
    )
    found = F.col("_value") == F.col("_key")
    for i in range(len(by)):
        found &= F.col(f"_by{i}") == F.col(f"_in{i}")
    if version:
        found &= F.col("_arrival") >= F.col("_first")
    combinations = filled.select(*[v.alias(n) for n, v in mine.items()]).distinct()
    unmet = combinations.join(first, found, "left_anti")
    same = reduce(Column.__and__, [value.eqNullSafe(F.col(n)) for n, value in mine.items()])
    return filled.join(unmet, same, "left_semi")


def orphan_counts(rows: DataFrame, column: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Rows and distinct values; copies of a value are counted before they are shuffled."""
    values = rows.groupBy(*by, F.col(column).alias("_value")).agg(F.count("*").alias("_n"))
    return values.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("Count"), F.count("_value").alias("DistinctCount")
    )


def orphan_samples(
    values: DataFrame, value: str, *, by: Sequence[str] = (), size: int = SAMPLE_SIZE
) -> DataFrame:
    """The first few distinct values of each group, in value order.

    The row limit reaches the map side of the window, so a group with very many orphans sends only
    ``size`` rows per task.
    """
    groups = [F.col(c) for c in by] or [F.lit(1)]
    first = Window.partitionBy(*groups).orderBy(value)
    return (
        values.select(*by, value)
        .distinct()
        .withColumn("Position", F.row_number().over(first))
        .where(F.col("Position") <= size)
    )


def orphan_values(
    tables: Mapping[str, DataFrame],
    registry: Registry,
    *,
    bound: int | None = None,
    in_order: bool = True,
    by_extract: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """Every declared foreign key at once: ``ForeignKeyId, scope, Value, Count``.

    ``scope`` is the practice of the child rows, or ``'*'`` for common tables. Each table is read
    twice for all its foreign keys and once for each column that keys point at. ``by_extract`` counts the
    orphans of every extract apart (``ExtractId``); since a parent that comes later never helps, those up
    to an extract are the outcome as of it: one check answers every bound, see :func:`orphan_totals_at`.
    """
    if by_extract and not in_order:
        raise ValueError("without the order of arrival, an earlier outcome is not part of a later one")
    plan = _KeyPlan.of(registry, tables)
    children = _union(
        _child_values(tables[name], plan.children(name), bound, collation)
        for name in sorted({fk.from_table for fk in plan.keys})
    ).withColumn("_n", F.lit(1))
    parents = _union(
        _first_seen(tables[table], column, n, bound, collation)
        for n, (table, column) in enumerate(plan.targets)
    )
    return _unmet(children, parents, plan, in_order, collation, by_extract)


@dataclass(frozen=True)
class _KeyPlan:
    """The foreign keys between the given tables, by number, and the columns they point at."""

    keys: list[ForeignKey]
    targets: list[tuple[str, str]]
    in_practice: list[bool]

    @classmethod
    def of(cls, registry: Registry, tables: Mapping[str, DataFrame]) -> _KeyPlan:
        keys = [fk for fk in registry.foreign_keys if fk.from_table in tables]
        targets = sorted({(fk.to_table, fk.to_column) for fk in keys})
        return cls(keys, targets, [registry.table(fk.to_table).kind == PRACTICE for fk in keys])

    def children(self, table: str) -> list[tuple[int, ForeignKey]]:
        return [(n, fk) for n, fk in enumerate(self.keys) if fk.from_table == table]

    def target(self, fk: ForeignKey) -> int:
        return self.targets.index((fk.to_table, fk.to_column))

    def per_key(self, values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("_fk"))


def _unmet(
    children: DataFrame,
    parents: DataFrame,
    plan: _KeyPlan,
    in_order: bool,
    collation: str | None,
    by_extract: bool = False,
) -> DataFrame:
    """The child values (``_fk, scope, Value, ExtractId, _n``) that no parent meets in time.

    What is sought is reduced to one row per value before it meets the parents, so a value that all
    practices use in all extracts is one row in that join. Only the values that are missing or
    late go back to the child rows. Both sides of that join are plain shuffles (the values are listed
    per foreign key, which no earlier step is partitioned by), so it is split at run time if one
    value has very many rows.
    """
    children = children.withColumn(
        "_sought_in",
        F.when(plan.per_key(plan.in_practice), F.col("scope")).otherwise(EVERYWHERE),
    )
    # The value leads in groups and joins: a sort compares by the first column wherever that tells rows apart.
    sought = children.groupBy(
        "Value", "_sought_in", plan.per_key([plan.target(fk) for fk in plan.keys]).alias("_target")
    ).agg(F.min(VERSION).alias("_earliest"))
    first = parents.groupBy("_key", "_seen_in", "_to").agg(F.min(VERSION).alias("_first"))
    # A left join and a filter rather than an anti join: that one would be pushed below the union
    # of the children and so repeated, with all parents, for every table.
    met = sought.join(
        first,
        (F.col("Value") == F.col("_key"))
        & (F.col("_sought_in") == F.col("_seen_in"))
        & (F.col("_target") == F.col("_to")),
        "left",
    )
    doubtful = F.col("_first").isNull()
    if in_order:
        doubtful |= F.col("_earliest") < F.col("_first")
    of_target = [
        F.array(*[F.lit(n) for n, fk in enumerate(plan.keys) if plan.target(fk) == t])
        for t in range(len(plan.targets))
    ]
    suspects = met.where(doubtful).select(
        F.explode(F.get(F.array(*of_target), F.col("_target"))).alias("_for"),
        F.col("_sought_in").alias("_in"),
        F.col("Value").alias("_value"),
        "_first",
    )
    unmet = F.col("_first").isNull()
    if in_order:
        unmet |= F.col(VERSION) < F.col("_first")
    found = children.join(
        suspects,
        (F.col("Value") == F.col("_value"))
        & (F.col("_sought_in") == F.col("_in"))
        & (F.col("_fk") == F.col("_for")),
    ).where(unmet)
    totals = found.groupBy(
        plan.per_key([fk.id for fk in plan.keys]).alias("ForeignKeyId"),
        "scope", "Value", *([VERSION] if by_extract else []),
    ).agg(F.sum("_n").alias("Count"))
    return totals.withColumn("Value", F.collate("Value", "UTF8_BINARY")) if collation else totals


def orphan_totals(values: DataFrame) -> DataFrame:
    """``ForeignKeyId, scope, Count, DistinctCount`` of the output of :func:`orphan_values`."""
    return values.groupBy("ForeignKeyId", "scope").agg(
        F.sum("Count").alias("Count"), F.count("*").alias("DistinctCount")
    )


def orphan_totals_at(values: DataFrame, bounds: Sequence[int]) -> DataFrame:
    """The totals as of each of several extracts, ``AsOfExtract`` telling which, in one pass.

    ``values`` are :func:`orphan_values` counted by extract. A value has one row from here on: its count up
    to each bound; a value counts as distinct where that is not zero.
    """
    if not bounds:
        raise ValueError("give at least one extract")
    upto = [
        F.sum(F.when(F.col(VERSION) <= b, F.col("Count"))).alias(f"_n{i}")
        for i, b in enumerate(bounds)
    ]
    per_value = values.groupBy("ForeignKeyId", "scope", "Value").agg(*upto)
    totals = per_value.groupBy("ForeignKeyId", "scope").agg(
        *[
            F.struct(
                F.lit(b).alias("AsOfExtract"), F.sum(f"_n{i}").alias("Count"),
                F.count(f"_n{i}").alias("DistinctCount"),
            ).alias(f"_t{i}")
            for i, b in enumerate(bounds)
        ]
    )
    listed = F.array(*[f"_t{i}" for i in range(len(bounds))])
    return totals.select("ForeignKeyId", "scope", F.inline(listed)).where("DistinctCount > 0")


def orphan_values_as_of(
    tables: Mapping[str, DataFrame],
    registry: Registry,
    extract: int | None = None,
    *,
    collation: str | None = None,
) -> DataFrame:
    """The other reading of the check: both sides as of an extract, deletions applied.

    The state of each table is taken once, all its child and parent columns come out of the same
    frame, and the values are counted and written to the shared folder, where every later step reads
    them: a table that the session's end removes.
    """
    plan = _KeyPlan.of(registry, tables)
    values = _union(
        _marked_values(as_of(tables[name], registry.table(name), extract, collation=collation),
                       name, plan)
        for name in sorted({fk.from_table for fk in plan.keys} | {t for t, _ in plan.targets})
    )
    counted = written_once(
        values.groupBy("_number", "scope", "Value", VERSION).agg(F.count("*").alias("_n")), "values"
    )
    kept = len(plan.keys)
    value = comparable("Value", collation)
    children = counted.where(F.col("_number") < kept).select(
        F.col("_number").alias("_fk"), "scope", value.alias("Value"), VERSION, "_n"
    )
    parents = counted.where(F.col("_number") >= kept).select(
        (F.col("_number") - kept).alias("_to"),
        F.col("scope").alias("_seen_in"), value.alias("_key"), VERSION,
    )
    return _unmet(children, parents, plan, False, collation)


def _marked_values(df: DataFrame, name: str, plan: _KeyPlan) -> DataFrame:
    """All values of a table's child and parent columns, numbered: keys first, then targets."""
    columns = {str(n): fk.from_column for n, fk in plan.children(name)}
    kept = len(plan.keys)
    columns |= {str(kept + n): c for n, (table, c) in enumerate(plan.targets) if table == name}
    wide = df.select(
        _scope(df).alias("scope"),
        F.col(VERSION).cast("int").alias(VERSION),
        *[F.col(c).cast("string").alias(n) for n, c in columns.items()],
    )
    long = wide.unpivot(["scope", VERSION], list(columns), "_number", "Value")
    number = F.col("_number").cast("int")
    return long.where(
        is_filled("Value") | ((number >= kept) & F.col("Value").isNotNull())
    ).select(number.alias("_number"), "scope", VERSION, "Value")


def _scope(df: DataFrame) -> Column:
    return F.col(TENANT).cast("string") if TENANT in df.columns else F.lit(EVERYWHERE)


def _child_values(
    df: DataFrame,
    keys: list[tuple[int, ForeignKey]],
    bound: int | None,
    collation: str | None,
) -> DataFrame:
    wide = up_to(df, bound).select(
        _scope(df).alias("scope"),
        F.col(VERSION).cast("int").alias(VERSION),
        *[F.col(fk.from_column).cast("string").alias(str(n)) for n, fk in keys],
    )
    long = wide.unpivot(["scope", VERSION], [str(n) for n, _ in keys], "_fk", "Value")
    return (
        long.where(is_filled("Value"))
        .select(
            F.col("_fk").cast("int").alias("_fk"),
            "scope",
            VERSION,
            comparable("Value", collation).alias("Value"),
        )
    )


def _first_seen(
    df: DataFrame, column: str, number: int, bound: int | None, collation: str | None
) -> DataFrame:
    return (
        up_to(df, bound)
        .where(F.col(column).isNotNull())
        .select(
            F.lit(number).alias("_to"),
            _scope(df).alias("_seen_in"),
            comparable(F.col(column).cast("string"), collation).alias("_key"),
            F.col(VERSION).cast("int").alias(VERSION),
        )
    )


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
