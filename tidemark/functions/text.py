"""Splitting text and repairing the end of a quoted file."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.keys import col


def parts(value: str | Column, delimiter: str) -> Column:
    """The parts between literal delimiters as an array; empty parts are kept."""
    if len(delimiter) != 1:
        raise ValueError("the delimiter must be a single character")
    return F.split(col(value), re.escape(delimiter), -1)


def split_rows(df: DataFrame, value: str, delimiter: str) -> DataFrame:
    """One row per part, with its place from 1 on (``Id``) and its text (``Data``)."""
    exploded = df.select("*", F.posexplode(parts(value, delimiter)).alias("_pos", "Data"))
    return exploded.withColumn("Id", F.col("_pos") + 1).drop("_pos")


def has_trailing_quote(value: str | Column) -> Column:
    """True for the one value per file that still holds the closing quote of the last record."""
    return F.coalesce(F.translate(col(value), "\r\n", "").endswith('"'), F.lit(False))


def without_trailing_quote(value: str | Column) -> Column:
    """That value without any quote or line end; every other value unchanged."""
    value = col(value)
    return F.when(has_trailing_quote(value), F.translate(value, '"\r\n', "")).otherwise(value)


def listed(column: str, separator: str = ", ") -> Column:
    """Aggregate: the values in order, joined by a separator; null if there are none."""
    name = "`" + column.replace("`", "``") + "`"
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"listagg({name}, '{quoted}') within group (order by {name})")
