"""File names of extracts: ``start-end_Schema_Table_yyyyMMddHHmmss_guid.csv``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.keys import col, guid_text, whole_number
from tidemark.functions.text import parts

SUFFIX = ".csv"
FILE_TYPE = "<<FILE_TYPE>>"


PARTS = (
    "ProcessingIdStart",
    "ProcessingIdEnd",
    "SchemaName",
    "TableName",
    "ExtractDateString",
    "ExtractDate",
    "SharingAgreementGuid",
)


def with_parsed_name(df: DataFrame, column: str) -> DataFrame:
    """The frame with the parts of a file name and ``parse_error``, the first rule it breaks.

    Good names have a null ``parse_error``; for bad ones every part is null. The steps are separate
    projections, so that each is evaluated once per row.
    """
    name = F.col(column)
    stem = F.substring(name, F.lit(1), F.length(name) - len(SUFFIX))
    cut = df.withColumn("_pieces", parts(stem, "_"))

    def piece(i: int) -> Column:
        return F.get("_pieces", F.lit(i))

    ids = cut.withColumns({"_ids": parts(piece(0), "-"), "ExtractDateString": piece(3)})
    typed = ids.withColumns(
        {
            "ProcessingIdStart": whole_number(F.get("_ids", F.lit(0))),
            "ProcessingIdEnd": whole_number(F.get("_ids", F.lit(1))),
            "SchemaName": piece(1),
            "TableName": piece(2),
            "ExtractDate": compact_date("ExtractDateString"),
            "SharingAgreementGuid": guid_text(piece(4)),
        }
    )
    checked = typed.withColumn(
        "parse_error",
        F.when(name.isNull(), "file name is null")
        .when(~F.lower(name).endswith(SUFFIX), "file name does not end in .csv")
        .when(F.size("_pieces") != 5, "file name does not have five parts")
        .when(F.col("SharingAgreementGuid").isNull(), "sharing agreement is not an identifier")
        .when(F.size("_ids") != 2, "processing ids are not a pair")
        .when(
            F.col("ProcessingIdStart").isNull() | F.col("ProcessingIdEnd").isNull(),
            "processing id is not a number",
        )
        .when(
            (F.rtrim("SchemaName") == "") | (F.rtrim("TableName") == ""),
            "schema or table name is empty",
        )
        .when(
            F.length(F.rtrim("ExtractDateString")) != 14, "extract date is not 14 digits"
        )
        .when(F.col("ExtractDate").isNull(), "extract date is not a date"),
    )
    good = F.col("parse_error").isNull()
    return checked.select(
        *df.columns, *[F.when(good, F.col(p)).alias(p) for p in PARTS], "parse_error"
    )


def compact_date(value: str | Column) -> Column:
    """``yyyyMMddHHmmss`` as a timestamp without zone; null if it is not one."""
    text = col(value)

    def digits(start: int, length: int) -> Column:
        return F.substring(text, start, length)

    day = F.concat_ws("-", digits(1, 4), digits(5, 2), digits(7, 2))
    time = F.concat_ws(":", digits(9, 2), digits(11, 2), digits(13, 2))
    return F.when(
        text.rlike("^[0-9]{14}$"), F.concat_ws(" ", day, time).try_cast("timestamp_ntz")
    )


def name_template(start: Column, end: Column, stamp: Column, guid: Column) -> Column:
    """The file name shared by all tables of an extract, with a placeholder for the table."""
    return F.concat(
        start.cast("string"), F.lit("-"), end.cast("string"), F.lit(f"_{FILE_TYPE}_"),
        stamp, F.lit("_"), guid, F.lit(SUFFIX),
    )
