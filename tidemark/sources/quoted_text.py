"""Quoted text tables.

Every field is quoted, ``","`` stands between fields, a line end between records, the first record
is the header. Fields may hold line ends and quotes. A record's outer quotes belong to the separators:
the file is cut at ``"<line end>"``, which keeps it splittable over tasks; what is left of the last
record is its closing quote. Doubled quotes stay doubled, as in the history they are compared with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import has_trailing_quote, without_trailing_quote
from tidemark.registry import Table
from tidemark.sources.shared import literal

BETWEEN = '","'
QUOTED, REPEATED, RAGGED, WIDE = "_quoted", "_repeated_header", "_ragged", "_wide"
FLAGS = (QUOTED, REPEATED, RAGGED, WIDE)
FILE = "_file"


@dataclass(frozen=True)
class Shape:
    """What the first line of a file tells: its column names and its line ends."""

    columns: tuple[str, ...]
    line_end: str
    header: str

    @property
    def separator(self) -> str:
        return f'"{self.line_end}"'

    def is_header(self, value: Column) -> Column:
        """The header as the reader sees it: with rows after it, or alone in its file."""
        alone = [self.header + '"' + tail for tail in ("", "\n", "\r\n")]
        return value.isin(self.header, *alone)


def read_shape(spark: SparkSession, path: str) -> Shape:
    """Read the first line only: one task, one buffer."""
    first = (
        spark.read.option("lineSep", "\n").text(literal(path))
        .where(F.col("_metadata.file_block_start") == 0)
        .head(1)
    )
    if not first:
        raise ValueError(f"{path}: the file is empty")
    line = first[0].value
    line_end = "\r\n" if line.endswith("\r") else "\n"
    line = line.removesuffix("\r")
    text = line.removeprefix("\ufeff")
    if len(text) < 2 or not (text.startswith('"') and text.endswith('"')):
        raise ValueError(f"{path}: the header is not quoted")
    return Shape(tuple(text[1:-1].split(BETWEEN)), line_end, line[:-1])


def read_records(spark: SparkSession, path: str, shape: Shape) -> DataFrame:
    """The records after the header, cut into an array of fields."""
    raw = (
        spark.read.option("lineSep", shape.separator)
        .text(literal(path))
        .select(
            "value",
            F.col("_metadata.file_block_start").alias("_start"),
            F.col("_metadata.file_path").alias(FILE),
        )
    )
    is_header = (F.col("_start") == 0) & shape.is_header(F.col("value"))
    second_header = shape.is_header(F.concat(F.lit('"'), F.col("value")))
    return raw.where(~is_header).select(
        FILE,
        second_header.alias(REPEATED),
        F.split("value", BETWEEN, -1).alias("_fields"),
    )


def read_extract_table(
    spark: SparkSession, path: str, table: Table, shape: Shape | None = None
) -> DataFrame:
    """The rows of one table of an extract, repaired, with a flag for every way a row can be wrong.

    Rows are never dropped here. ``_quoted`` marks the row that held the closing quote of the file
    (exactly one per non-empty file if the file is whole), ``_repeated_header`` a header inside the
    data (files joined end to end), ``_ragged`` a wrong number of fields, ``_wide`` a value longer
    than declared. Empty fields are null.
    """
    shape = shape or read_shape(spark, path)
    records = read_records(spark, path, shape)
    width = len(table.columns)
    last = F.expr(f"get(_fields, {width - 1})")
    values = [
        F.expr(f"nullif(get(_fields, {i}), '') as {_quoted_name(c)}")
        for i, c in enumerate(table.columns[:-1])
    ]
    repaired = F.nullif(without_trailing_quote(last), F.lit("")).alias(table.last_column)
    rows = records.select(
        *values,
        repaired,
        has_trailing_quote(last).alias(QUOTED),
        REPEATED,
        (F.size("_fields") != width).alias(RAGGED),
        FILE,
    )
    return rows.withColumn(WIDE, exceeds_width(table))


def _quoted_name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def exceeds_width(table: Table) -> Column:
    """True if any value of the row is longer than its column allows."""
    too_long = [f"length({_quoted_name(c)}) > {table.width(c)}" for c in table.columns]
    return F.expr(f"coalesce({' or '.join(too_long)}, false)")


def rejected_records(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The records with a wrong number of fields, as read."""
    records = read_records(spark, path, read_shape(spark, path))
    return records.where(F.size("_fields") != len(table.columns)).select(
        FILE,
        F.size("_fields").alias("FieldCount"),
        F.array_join("_fields", BETWEEN).alias("Record"),
    )


def quote_counts(rows: DataFrame) -> DataFrame:
    """Rows and closing quotes per file; anything but one quote in a non-empty file is an error."""
    return (
        rows.groupBy(FILE)
        .agg(F.count("*").alias("Rows"), F.count_if(QUOTED).alias("QuotedRows"))
        .withColumn(
            "Problem",
            F.when(F.col("QuotedRows") == 0, "no row contains a trailing quote").when(
                F.col("QuotedRows") > 1, "more than one row contains a trailing quote"
            ),
        )
    )


def check_widths(df: DataFrame, table: Table) -> DataFrame:
    """``ColumnName, DeclaredWidth, LongestValue, TooLong`` for every column, in one pass."""
    measures, entries = [], []
    for i, c in enumerate(table.columns):
        length = f"length({_quoted_name(c)})"
        measures.append(F.expr(f"max({length}) as m{i}"))
        measures.append(F.expr(f"count_if({length} > {table.width(c)}) as n{i}"))
        entries.append(
            F.struct(
                F.lit(c).alias("ColumnName"),
                F.lit(table.width(c)).alias("DeclaredWidth"),
                F.col(f"m{i}").alias("LongestValue"),
                F.col(f"n{i}").alias("TooLong"),
            )
        )
    rows = F.array(*entries)
    return df.agg(*measures).select(F.inline(rows))
