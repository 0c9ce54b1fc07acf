"""Foreign-key checks that go on from extract to extract.

A child value is judged when it arrives: a parent that comes with the same extract or came before meets it for good,
and one that comes later no longer helps. So a check never has to go back. It keeps two tables: the keys parents
have sent, each with the extract that sent it first, and the orphans that have been found. A new extract is
looked at alone: its keys that are new go to the first table, its child values that the first table does not
hold go to the second. The orphans up to any extract are then a filter over the second.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.keys import comparable
from tidemark.operators.integrity import EVERYWHERE, _child_values, _first_seen, _KeyPlan, _union
from tidemark.registry import VERSION, Registry

#: Keys by the table and column that foreign keys point at; orphans by foreign key, with how many rows have them.
KEYS = "Target string, scope string, Value string, ExtractId int"
ORPHANS = "ForeignKeyId int, scope string, Value string, Count long, ExtractId int"


def arriving_keys(
    tables: Mapping[str, DataFrame],
    registry: Registry,
    known: DataFrame,
    extract: int,
    collation: str | None = None,
) -> DataFrame:
    """The keys that one extract brings and ``known`` (those of all earlier ones) has not.

    ``tables`` hold the rows of that extract alone; columns as in ``KEYS``. Copies of a key are reduced to one
    before anything is shuffled. A collation decides which keys are the same: the first spelling stays.
    """
    plan = _KeyPlan.of(registry, tables)
    sent = _union(
        _first_seen(tables[table], column, n, None, collation)
        for n, (table, column) in enumerate(plan.targets)
        if table in tables
    )
    names = F.array(*[F.lit(_name(t)) for t in plan.targets])
    sent = sent.where(F.col("_seen_in").isNotNull()).select(
        F.get(names, F.col("_to")).alias("Target"),
        F.col("_seen_in").alias("scope"),
        F.col("_key").alias("_value"),
    ).distinct()
    new = sent.join(known, _same(sent, known, "Target", "scope", collation), "left_anti")
    return new.select(
        "Target", "scope", _plain("_value", collation), F.lit(extract).alias(VERSION)
    )


def arriving_orphans(
    tables: Mapping[str, DataFrame],
    registry: Registry,
    known: DataFrame,
    extract: int,
    collation: str | None = None,
) -> DataFrame:
    """The child values of one extract that no key in ``known`` (its own included) meets; as ``ORPHANS``.

    Rows are counted by value before they are shuffled. The join is one of two plain shuffles, split at run
    time if one value is sought by very many practices.
    """
    plan = _KeyPlan.of(registry, tables)
    children = _union(
        _child_values(tables[name], plan.children(name), None, collation)
        for name in sorted({fk.from_table for fk in plan.keys})
    )
    counted = children.groupBy("_fk", "scope", F.col("Value").alias("_value")).agg(
        F.count("*").alias("Count")
    )
    sought = counted.withColumns(
        {
            "_target": plan.per_key([_name(plan.targets[plan.target(fk)]) for fk in plan.keys]),
            "_in": F.when(plan.per_key(plan.in_practice), F.col("scope")).otherwise(EVERYWHERE),
        }
    ).where(F.col("_in").isNotNull())
    unmet = sought.join(known, _same(sought, known, "_target", "_in", collation), "left_anti")
    return unmet.select(
        plan.per_key([fk.id for fk in plan.keys]).alias("ForeignKeyId"),
        "scope",
        _plain("_value", collation),
        "Count",
        F.lit(extract).alias(VERSION),
    )


def standing_values(
    orphans: DataFrame, extract: int | None = None, collation: str | None = None
) -> DataFrame:
    """``ForeignKeyId, scope, Value, Count`` of the orphans found up to an extract."""
    found = orphans if extract is None else orphans.where(F.col(VERSION) <= extract)
    values = found.groupBy(
        "ForeignKeyId", "scope", comparable("Value", collation).alias("_value")
    ).agg(F.sum("Count").alias("Count"))
    return values.select("ForeignKeyId", "scope", _plain("_value", collation), "Count")


def _name(target: tuple[str, str]) -> str:
    return ".".join(target)


def _same(
    rows: DataFrame, known: DataFrame, target: str, scope: str, collation: str | None
) -> Column:
    # The value first: a sort compares by the first column wherever that tells rows apart.
    return (
        (rows["_value"] == comparable(known["Value"], collation))
        & (rows[scope] == known["scope"])
        & (rows[target] == known["Target"])
    )


def _plain(value: str, collation: str | None) -> Column:
    return (F.collate(value, "UTF8_BINARY") if collation else F.col(value)).alias("Value")
