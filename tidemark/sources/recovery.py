"""Records whose values hold the separator.

A value with a literal ``","`` cuts its record into too many fields. Which neighbouring pieces belong
together can often be told from what is declared of the columns: widths, and patterns of their
values. Every way to give each column one piece or more is weighed, column by column over the
places where it may end; a record with exactly one way is recovered, one with none or several is not.
Tables that declare no patterns are read by ``quoted_text`` alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import has_trailing_quote, without_trailing_quote
from tidemark.registry import Table
from tidemark.sources.quoted_text import (
    BETWEEN,
    FILE,
    QUOTED,
    RAGGED,
    REPEATED,
    WIDE,
    Shape,
    exceeds_width,
    read_records,
    read_shape,
)

_STATE = "array<struct<ways:int,cuts:array<int>>>"


def _whole(pattern: str | None) -> str | None:
    return None if pattern is None else rf"\A(?:{pattern})\z"


def _fits(value: Column, about: Column) -> Column:
    """An empty value fits every column, any other one its width and its pattern."""

    def fits(v: Column) -> Column:
        matches = about["pattern"].isNull() | F.coalesce(F.rlike(v, about["pattern"]), F.lit(False))
        return (v == "") | ((F.length(v) <= about["width"]) & matches)

    # Bound by a list of one: the value is put together once for its three tests.
    return F.exists(F.array(value), fits)


def alignment(pieces: Column, table: Table) -> Column:
    """``ways`` (0, 1, or 2 for several) and ``cuts``, the pieces used up after each column.

    One pass over the columns keeps, for every number of pieces, whether they can make up the columns so
    far, so the work is columns x pieces x surplus pieces and does not grow with the number of
    ways. The expression does not grow with the table. The pieces are bound by a list of one: a filter over the
    outcome is moved below the step that cuts the record, and would cut it again at every place they are used.
    """
    return F.get(F.transform(F.array(pieces), lambda p: _alignment(p, table)), F.lit(0))


def _alignment(pieces: Column, table: Table) -> Column:
    width = len(table.columns)
    columns = F.array(*[
        F.struct(
            F.lit(table.width(c)).alias("width"),
            F.lit(_whole(table.patterns.get(c))).cast("string").alias("pattern"),
        )
        for c in table.columns
    ])
    n = F.size(pieces)
    places = F.sequence(F.lit(0), n)

    def end_at(state: Column, about: Column, i: Column) -> Column:
        """The ways in which the columns up to this one use up the first ``i`` pieces."""

        def starts_at(m: Column) -> Column:
            length = F.greatest(i - m, F.lit(0))
            value = F.array_join(F.slice(pieces, m + 1, length), BETWEEN)
            near = (m < i) & (i - m <= n - width + 1)
            return near & (F.get(state, m)["ways"] > 0) & _fits(value, about)

        # Bound by a list of one, since the places are used twice.
        return F.get(F.transform(F.array(F.filter(places, starts_at)), lambda s: F.struct(
            F.least(F.lit(2), F.aggregate(
                s, F.lit(0), lambda total, m: total + F.get(state, m)["ways"]
            )).alias("ways"),
            F.concat(F.get(state, F.get(s, F.lit(0)))["cuts"], F.array(i)).alias("cuts"),
        )), F.lit(0))

    start = F.transform(places, lambda i: F.struct(
        F.when(i == 0, 1).otherwise(0).alias("ways"), F.array().cast("array<int>").alias("cuts")
    )).cast(_STATE)
    final = F.aggregate(
        columns, start,
        lambda state, about: F.transform(places, lambda i: end_at(state, about, i)).cast(_STATE),
    )
    return F.get(final, n)


def _aligned(records: DataFrame, table: Table) -> DataFrame:
    """The records with ``_pieces`` and, for those with a wrong number of fields, the ``_way``."""
    # The closing quote of the file belongs to no value.
    last = without_trailing_quote(F.element_at("_fields", -1))
    pieces = F.concat(F.slice("_fields", 1, F.size("_fields") - 1), F.array(last))
    ragged = F.size("_fields") != len(table.columns)
    return records.withColumn("_pieces", pieces).withColumn(
        "_way", F.when(ragged, alignment(F.col("_pieces"), table))
    )


def read_aligned_table(
    spark: SparkSession, path: str, table: Table, shape: Shape | None = None
) -> DataFrame:
    """The rows of a table as :func:`read_extract_table` gives them, in one pass over the files.

    Records with a wrong number of fields that fit the columns in exactly one way are rows like all
    others; ``_ragged`` is left for those that do not.
    """
    shape = shape or read_shape(spark, path)
    records = _aligned(read_records(spark, path, shape), table)
    way = F.col("_way")

    def value(j: int, column: str) -> Column:
        before = F.get(way["cuts"], F.lit(j - 1)) if j else F.lit(0)
        piece = F.slice("_pieces", before + 1, F.get(way["cuts"], F.lit(j)) - before)
        plain = F.get("_pieces", F.lit(j))
        whole = F.when(way["ways"] == 1, F.array_join(piece, BETWEEN)).otherwise(plain)
        return F.nullif(whole, F.lit("")).alias(column)

    rows = records.select(
        *[value(j, c) for j, c in enumerate(table.columns)],
        has_trailing_quote(F.element_at("_fields", -1)).alias(QUOTED),
        REPEATED,
        F.coalesce(way["ways"] != 1, F.lit(False)).alias(RAGGED),
        FILE,
    )
    return rows.withColumn(WIDE, exceeds_width(table))


def unaligned_records(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The records that stay unread: ``FieldCount, Alignments`` (0, or 2 for several), ``Record``, file."""
    records = read_records(spark, path, read_shape(spark, path))
    ragged = records.where(F.size("_fields") != len(table.columns))
    return _aligned(ragged, table).where(F.col("_way")["ways"] != 1).select(
        F.size("_fields").alias("FieldCount"),
        F.col("_way")["ways"].alias("Alignments"),
        F.array_join("_fields", BETWEEN).alias("Record"),
        FILE,
    )
