"""Histories as SQL: a view and a table function per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.versioned import current
from tidemark.registry import VERSION, Registry, Table


def register_views(
    spark: SparkSession,
    histories: Mapping[str, DataFrame],
    registry: Registry,
    recent: Mapping[str, DataFrame] | None = None,
) -> None:
    """Make every history available to SQL in this session.

    ``recent`` (see ``sources.history.recent_histories``) spares ``vw_<table>`` the extracts that a
    saved state covers.

    ``history_<table>`` holds all versions, ``vw_<table>`` the current state, and
    ``fn_<table>(n)`` the state as of extract n (null: the newest).
    """
    for name, history in histories.items():
        table = registry.table(name)
        history.createOrReplaceTempView(f"history_{name}")
        newest = (recent or {}).get(name, history)
        current(newest, table).createOrReplaceTempView(f"vw_{name}")
        spark.sql(_as_of_function(history, table))


def _as_of_function(history: DataFrame, table: Table) -> str:
    def quoted(column: str) -> str:
        return "`" + column.replace("`", "``") + "`"

    def named(column: str) -> str:
        return f"h.{quoted(column)}"

    source = f"history_{table.name}"
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in history.schema)
    keys = table.scoped_keys(history.columns)
    conditions, newest = [], ""
    if VERSION in history.columns:
        conditions.append(f"({named(VERSION)} <= n or n is null)")
        if keys:
            same = " and ".join(f"{named(k)} = e.{quoted(k)}" for k in keys)
            of = ", ".join(quoted(k) for k in keys)
            newest = f"""
                left semi join (
                    select {of}, max({VERSION}) as newest from {source}
                    where {VERSION} <= n or n is null group by {of}
                ) e on {same} and {named(VERSION)} = e.newest"""
    if table.deleted:
        conditions.append(f"{named(table.deleted)} = 'false'")
    where = f"where {' and '.join(conditions)}" if conditions else ""
    columns = ", ".join(named(c) for c in history.columns)
    return f"""
        create or replace temporary function fn_{table.name}(n int) returns table ({fields})
        return select {columns} from {source} h {newest} {where}"""
