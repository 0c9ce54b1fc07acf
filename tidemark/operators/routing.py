"""Sending the rows of an extract to their practices, and proving that none is left over."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.keys import tenant_key
from tidemark.registry import COMMON, TENANT, Table


def installed_practices(organisations: DataFrame) -> DataFrame:
    """``_org, practice`` of the sharing organisations that are configured."""
    return organisations.where("IsInstalled").select(
        tenant_key("OrganisationGuid").alias("_org"), F.col("PracticeDBName").alias(TENANT)
    )


def route_rows(
    rows: DataFrame,
    table: Table,
    installed: DataFrame,
    parent: DataFrame | None = None,
) -> DataFrame:
    """Every row with its practice, null for rows that belong to none; one job for all practices.

    A table that finds its practice through a parent row takes the parents of the same extract: a
    parent sent twice doubles the row, as the inner join it stands for does. Neither join is hinted;
    the list of practices is broadcast if its size allows it and a practice holding a large share of
    the rows is split by the adaptive skew join if not.
    """
    if table.kind == COMMON:
        return rows
    if table.via is None:
        return rows.join(
            installed, tenant_key(table.tenant) == F.col("_org"), "left"
        ).drop("_org")
    if parent is None:
        raise ValueError(f"{table.name} is routed through {table.via.parent}")
    homes = parent.select(F.col(table.via.parent_key).alias("_parent"), TENANT).where(
        F.col(TENANT).isNotNull()
    )
    return rows.join(homes, F.col(table.via.column) == F.col("_parent"), "left").drop("_parent")


def residual_rows(rows: DataFrame, table: Table, installed: DataFrame) -> DataFrame:
    """The rows of a practice table that no configured, sharing practice takes."""
    return rows.join(installed, tenant_key(table.tenant) == F.col("_org"), "left_anti")


def counts_by_practice(routed: DataFrame, table: str) -> DataFrame:
    """Rows per practice of one table; the null practice is what stayed behind."""
    return (
        routed.groupBy(TENANT)
        .agg(F.count("*").alias("Rows"))
        .select(F.lit(table).alias("TableName"), TENANT, "Rows")
    )
