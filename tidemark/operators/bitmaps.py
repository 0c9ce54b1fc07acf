"""Exact distinct counts that can be merged: values numbered once, sets of numbers as bitmaps.

Counts of distinct values of practices or extracts cannot be added, since they share values. Their
bitmaps can be merged in any combination without going back to the values. Numbers are given
in the order of the practice that first had a value, so values of one practice are neighbours
and fill few bitmaps; a bitmap stands for 32,768 neighbouring numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.registry import VERSION

NUMBERS = "ForeignKeyId int, Value string, Number long"
BITMAPS = f"ForeignKeyId int, scope string, {VERSION} int, Bucket long, Bitmap binary"
# A task numbers its rows below 2^33 and there are at most 2^20 tasks: a batch has 2^53 numbers.
BATCH_BITS = 53
BATCHES = 1 << (63 - BATCH_BITS)


def new_numbers(values: DataFrame, known: DataFrame, batch: int) -> DataFrame:
    """Numbers (as ``NUMBERS``) for the (ForeignKeyId, Value) pairs that ``known`` has none for.

    ``batch`` counts the calls, from 0 to 1023, so that numbers of different calls never meet. Numbers are
    the places of the rows in their tasks: write them before they are used, since a stage that runs
    again may deal its rows otherwise. Null values have no number.
    """
    if not 0 <= batch < BATCHES:
        raise ValueError(f"batch is 0 to {BATCHES - 1}")
    found = (
        values.where(F.col("Value").isNotNull())
        .groupBy("Value", "ForeignKeyId")
        .agg(F.min("scope").alias("_scope"))
        .join(known.select("ForeignKeyId", "Value"), ["Value", "ForeignKeyId"], "left_anti")
    )
    # By range: neighbours share a task, and a practice with very many values is cut by value.
    order = ["ForeignKeyId", "_scope", "Value"]
    return (
        found.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "ForeignKeyId",
            "Value",
            (F.monotonically_increasing_id() + F.lit(batch << BATCH_BITS)).alias("Number"),
        )
    )


def value_bitmaps(values: DataFrame, numbers: DataFrame) -> DataFrame:
    """The values (``ForeignKeyId, scope, Value, ExtractId``) as ``BITMAPS``; copies change nothing.

    The numbers of a bitmap are brought together before it is made: a task of the join has a few numbers of very
    many bitmaps, and would send nearly one of 4 KB for each. A task then has as many numbers per bitmap as
    there are values in it, 32,768 at most; copies of a value are best counted before, as ``orphan_values`` does.
    """
    number = F.col("Number")
    groups = ["Bucket", "scope", VERSION, "ForeignKeyId"]
    placed = values.join(numbers, ["Value", "ForeignKeyId"]).select(
        "ForeignKeyId", "scope", VERSION, F.bitmap_bucket_number(number).alias("Bucket"),
        F.bitmap_bit_position(number).alias("_position"),
    )
    made = placed.repartition(*groups).groupBy(*groups).agg(
        F.bitmap_construct_agg("_position").alias("Bitmap")
    )
    return made.select("ForeignKeyId", "scope", VERSION, "Bucket", "Bitmap")


def distinct_counts(bitmaps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """``DistinctCount`` per group of any columns beside the bitmaps: parts of a group are merged first.

    Merged on the map side as well, so a group of very many bitmaps sends one per bucket and task.
    """
    groups = [F.col(b) if isinstance(b, str) else b for b in by]
    keyed = bitmaps.select(
        *[g.alias(f"_g{i}") for i, g in enumerate(groups)], "Bucket", "Bitmap"
    )
    names = [f"_g{i}" for i in range(len(groups))]
    merged = keyed.groupBy(*names, "Bucket").agg(F.bitmap_or_agg("Bitmap").alias("Bitmap"))
    counted = merged.groupBy(*names).agg(
        F.coalesce(F.sum(F.bitmap_count("Bitmap")), F.lit(0)).alias("DistinctCount")
    )
    plain = bitmaps.select(*groups).columns
    return counted.select(*[F.col(n).alias(p) for n, p in zip(names, plain)], "DistinctCount")
