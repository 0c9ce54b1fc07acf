"""The text of a validation run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.integrity import SAMPLE_SIZE

# The wording and the formats of the report.
TITLE = "Data Integrity Report"
PRACTICE = "Practice: %s/ %s"
EXTRACT = "Extract Id: %d"
EXTRACT_DATE = "Extract date: %s"
VALIDATION_DATE = "Validation date: %s"
RULE = "-" * 52
TABLE = ">>Table %s"
COLUMN = "  >Column %s"
MESSAGE = "     [ERROR]  %d (%d distinct) %s value(s) not present in %s (column %s)"
SOME_VALUES = "     First ten distinct value(s) are:"
ALL_VALUES = "     Distinct value(s) are:"
VALUE = "         %s"
STAMP = "yyyy-MM-dd HH:mm:ss"


def _lines(df: DataFrame, *texts: Column | str) -> DataFrame:
    items = F.array(*[F.lit(t) if isinstance(t, str) else t for t in texts])
    return df.select("*", F.posexplode(items).alias("_line", "Line"))


def report_lines(
    runs: DataFrame, errors: DataFrame, samples: DataFrame, foreign_keys: DataFrame
) -> DataFrame:
    """``RunId, LineId, Line`` of the given runs.

    ``runs`` needs RunId, ODSCode, PracticeName, ExtractId, ExtractDate and RunDate; ``samples``
    holds RunId, ForeignKeyId, Position and Value. Tables and columns come in name order; a run has
    at most a header, and a title, a message and ten values per foreign key.
    """
    heading = _lines(
        runs,
        TITLE,
        F.format_string(PRACTICE, "ODSCode", "PracticeName"),
        F.format_string(EXTRACT, "ExtractId"),
        F.format_string(EXTRACT_DATE, F.date_format("ExtractDate", STAMP)),
        F.format_string(VALIDATION_DATE, F.date_format("RunDate", STAMP)),
        "",
    )
    failed = errors.select("RunId", "ForeignKeyId", "Count", "DistinctCount").join(
        foreign_keys, "ForeignKeyId"
    )
    tables = _lines(
        failed.select("RunId", "FromTable").distinct(),
        RULE, F.format_string(TABLE, "FromTable"), RULE, "",
    )
    columns = _lines(
        failed,
        F.format_string(COLUMN, "FromColumn"),
        "",
        F.format_string(
            MESSAGE, "Count", "DistinctCount", "FromColumn", "ToTable", "ToColumn"
        ),
        "",
        F.when(F.col("DistinctCount") > SAMPLE_SIZE, SOME_VALUES).otherwise(ALL_VALUES),
    )
    values = samples.join(
        foreign_keys.select("ForeignKeyId", "FromTable", "FromColumn"), "ForeignKeyId"
    ).select(
        "RunId", "FromTable", "FromColumn", F.col("Position").alias("_line"),
        F.format_string(VALUE, "Value").alias("Line"),
    )
    ends = _lines(failed, "")

    def part(df: DataFrame, section: int) -> DataFrame:
        def named(column: str) -> Column:
            return F.col(column) if column in df.columns else F.lit("")

        return df.select(
            "RunId",
            named("FromTable").alias("_table"),
            (named("FromColumn") if section > 1 else F.lit("")).alias("_column"),
            F.lit(section).alias("_section"),
            "_line",
            "Line",
        )

    sections = [heading, tables, columns, values, ends]
    text = reduce(DataFrame.unionByName, [part(df, n) for n, df in enumerate(sections)])
    in_order = Window.partitionBy("RunId").orderBy("_table", "_column", "_section", "_line")
    return text.select("RunId", F.row_number().over(in_order).alias("LineId"), "Line")
