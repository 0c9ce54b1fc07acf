"""Declared rules of the control tables, checked as queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"unique ({', '.join(self.columns)})"

    def violations(self, df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
        return repeated_keys(df, self.columns)


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"not null ({self.column})"

    @property
    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Reference:
    column: str
    table: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.column} in {self.table} ({self.key})"

    def violations(self, df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
        known = tables[self.table].select(F.col(self.key).alias("_known"))
        return df.where(F.col(self.column).isNotNull()).join(
            known, F.col(self.column) == F.col("_known"), "left_anti"
        )


@dataclass(frozen=True)
class Check:
    """A condition every row must meet; as in SQL, one that comes out null is met."""

    condition: str

    @property
    def name(self) -> str:
        return self.condition

    @property
    def broken(self) -> Column:
        return ~F.expr(self.condition)


Constraint = Unique | NotNull | Reference | Check


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*columns).agg(F.count("*").alias("Rows")).where("Rows > 1")


def check_constraints(
    tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Constraint]]
) -> DataFrame:
    """``TableName, Rule, Violations`` for every rule, kept or broken.

    All rules about single rows of a table are counted in one pass over it.
    """
    parts = []
    for table, table_rules in rules.items():
        by_row = [r for r in table_rules if isinstance(r, NotNull | Check)]
        if by_row:
            counts = [F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(by_row)]
            entries = [
                F.struct(F.lit(r.name).alias("Rule"), F.col(f"r{i}").alias("Violations"))
                for i, r in enumerate(by_row)
            ]
            one = tables[table].agg(*counts).select(F.inline(F.array(*entries)))
            parts.append(one.select(F.lit(table).alias("TableName"), "Rule", "Violations"))
        for rule in table_rules:
            if rule not in by_row:
                count = rule.violations(tables[table], tables).agg(
                    F.count("*").alias("Violations")
                )
                parts.append(
                    count.select(
                        F.lit(table).alias("TableName"), F.lit(rule.name).alias("Rule"),
                        "Violations",
                    )
                )
    return reduce(DataFrame.unionByName, parts)


# The rules of the control tables.
CONTROL_RULES: dict[str, tuple[Constraint, ...]] = {
    "InstalledExtracts": (Unique(("ExtractId",)),),
    "ConfiguredPractices": (
        Unique(("OrganisationGuid",)),
        Unique(("ODSCode",)),
        Unique(("CDB",)),
        Unique(("PracticeDBName",)),
        NotNull("OrganisationGuid"),
        NotNull("PracticeName"),
        NotNull("ODSCode"),
        NotNull("CDB"),
        Reference("StartExtractId", "InstalledExtracts", "ExtractId"),
        Reference("ConfiguredAfter", "InstalledExtracts", "ExtractId"),
        Check("NewlyConfigured or ConfiguredAfter is null"),
        Check("NewlyConfigured = (StartExtractId is null)"),
    ),
    "Run": (
        Unique(("RunId",)),
        Reference("PracticeDBName", "ConfiguredPractices", "PracticeDBName"),
        Reference("ExtractId", "InstalledExtracts", "ExtractId"),
    ),
    "RunText": (Unique(("RunId", "LineId")), Reference("RunId", "Run", "RunId")),
    "ForeignKeyErrors": (Unique(("RunId", "ForeignKeyId")), Reference("RunId", "Run", "RunId")),
}
