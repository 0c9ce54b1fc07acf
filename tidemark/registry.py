"""What the jobs know about the tables: kind, keys, delete flag, tenant path, widths, foreign keys.

Nothing here is tied to one set of tables. ``tidemark.care_records`` holds the registry for the
care-record extracts; tests and ``__spark_entry__`` build their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession, types as T

COMMON = "C"
PRACTICE = "P"
KINDS = {PRACTICE: "Practice table", COMMON: "Common table"}

VERSION = "ExtractId"
TENANT = "practice"

DEFAULT_WIDTH = 50


@dataclass(frozen=True)
class Via:
    """A table without a tenant column takes the tenant of a parent row in the same extract."""

    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class Table:
    name: str
    kind: str
    keys: tuple[str, ...] = ()
    deleted: str | None = None
    tenant: str | None = "OrganisationGuid"
    via: Via | None = None
    columns: tuple[str, ...] = ()
    widths: Mapping[str, int] = field(default_factory=dict)
    #: What a whole value of a column matches unless it is empty; records of a table that has some are
    #: recovered if a separator inside a value cut them (see ``sources.recovery``).
    patterns: Mapping[str, str] = field(default_factory=dict)

    def width(self, column: str) -> int:
        """The declared width; ``widths`` may name columns by pattern (``*Description``)."""
        for pattern, width in self.widths.items():
            if fnmatchcase(column, pattern):
                return width
        return DEFAULT_WIDTH

    @property
    def last_column(self) -> str:
        if not self.columns:
            raise ValueError(f"{self.name}: the column layout is not known yet")
        return self.columns[-1]

    @property
    def schema(self) -> T.StructType:
        """Every extract column is text; the declared width travels as field metadata."""
        if not self.columns:
            raise ValueError(f"{self.name}: the column layout is not known yet")
        return T.StructType(
            [T.StructField(c, T.StringType(), True, {"width": self.width(c)}) for c in self.columns]
        )

    @property
    def history_schema(self) -> T.StructType:
        """The extract columns, then the tenant (practice tables only), then the version."""
        fields = list(self.schema.fields)
        if self.kind == PRACTICE:
            fields.append(T.StructField(TENANT, T.StringType(), False))
        fields.append(T.StructField(VERSION, T.IntegerType(), False))
        return T.StructType(fields)

    def scoped_keys(self, columns: Sequence[str]) -> list[str]:
        """The key columns, led by the tenant where the frame carries one; empty if keyless."""
        if not self.keys:
            return []
        return ([TENANT] if TENANT in columns else []) + list(self.keys)


@dataclass(frozen=True)
class ForeignKey:
    id: int
    from_table: str
    from_column: str
    to_table: str
    to_column: str


@dataclass(frozen=True)
class Registry:
    tables: tuple[Table, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()

    def __post_init__(self) -> None:
        names = [t.name for t in self.tables]
        _reject_repeats("table", names)
        _reject_repeats("foreign key id", [fk.id for fk in self.foreign_keys])
        _reject_repeats(
            "foreign key column", [(fk.from_table, fk.from_column) for fk in self.foreign_keys]
        )
        for table in self.tables:
            if table.kind not in KINDS:
                raise ValueError(f"{table.name}: unknown kind {table.kind!r}")
            if table.via and table.via.parent not in names:
                raise ValueError(f"{table.name}: unknown parent table {table.via.parent!r}")
            self._check_columns(table)
        for fk in self.foreign_keys:
            for end in (fk.from_table, fk.to_table):
                if end not in names:
                    raise ValueError(f"foreign key {fk.id}: unknown table {end!r}")
            if (self.table(fk.from_table).kind, self.table(fk.to_table).kind) == (COMMON, PRACTICE):
                raise ValueError(f"foreign key {fk.id}: a common table cannot refer to practices")

    def _check_columns(self, table: Table) -> None:
        if not table.columns:
            return
        _reject_repeats(f"column of {table.name}", table.columns)
        needed = set(table.keys) | set(table.patterns)
        if table.deleted:
            needed.add(table.deleted)
        if table.kind == PRACTICE:
            needed.add(table.via.column if table.via else table.tenant)
        for fk in self.foreign_keys:
            if fk.from_table == table.name:
                needed.add(fk.from_column)
            if fk.to_table == table.name:
                needed.add(fk.to_column)
        missing = sorted(needed - set(table.columns))
        if missing:
            raise ValueError(f"{table.name}: layout lacks column(s) {', '.join(missing)}")

    def table(self, name: str) -> Table:
        for table in self.tables:
            if table.name == name:
                return table
        raise KeyError(f"unknown table {name!r}")

    def select(self, practice: bool = True, common: bool = True) -> list[Table]:
        wanted = {k for k, on in ((PRACTICE, practice), (COMMON, common)) if on}
        return [t for t in self.tables if t.kind in wanted]

    def with_layout(self, layout: Mapping[str, Iterable[str]]) -> Registry:
        """The same registry with the column order of the named tables filled in."""
        return replace(
            self,
            tables=tuple(
                replace(t, columns=tuple(layout[t.name])) if t.name in layout else t
                for t in self.tables
            ),
        )

    def kind_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(KINDS.items()), "TableType string, Description string")

    def table_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (t.name, t.kind, t.deleted, t.tenant if t.kind == PRACTICE and not t.via else None,
             t.via.parent if t.via else None)
            for t in self.tables
        ]
        return spark.createDataFrame(
            rows,
            "TableName string, TableType string, DeletedColumnName string, "
            "TenantColumn string, TenantParent string",
        )

    def key_frame(self, spark: SparkSession) -> DataFrame:
        """One row per key column, whatever the number of columns of a key."""
        rows = [
            (i, t.name, position, column)
            for i, t in enumerate(self.tables, 1)
            for position, column in enumerate(t.keys, 1)
        ]
        return spark.createDataFrame(
            rows, "PrimaryKeyId int, TableName string, Position int, ColumnName string"
        )

    def foreign_key_frame(self, spark: SparkSession) -> DataFrame:
        """One row per foreign key, with the kind of both ends."""
        rows = [
            (fk.id, self.table(fk.from_table).kind, fk.from_table, fk.from_column,
             self.table(fk.to_table).kind, fk.to_table, fk.to_column)
            for fk in self.foreign_keys
        ]
        return spark.createDataFrame(
            rows,
            "ForeignKeyId int, TableType string, FromTable string, FromColumn string, "
            "ToTableType string, ToTable string, ToColumn string",
        )


def _reject_repeats(what: str, values: Iterable) -> None:
    seen = set()
    for value in values:
        if value in seen:
            raise ValueError(f"{what} declared twice: {value!r}")
        seen.add(value)
