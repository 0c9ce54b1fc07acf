"""Validation results: one run against another, and many runs side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

FK_COLUMNS = ["TableType", "FromTable", "FromColumn", "ToTable", "ToColumn"]
# How a change is shown and how much of a practice name heads a column.
CHANGE = "  (%+d)"
NAME_LENGTH = 10


def failed_keys(errors: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """The foreign keys that failed in any run: the rows of every report."""
    failed = errors.select("ForeignKeyId").distinct()
    return foreign_keys.select("ForeignKeyId", *FK_COLUMNS).join(failed, "ForeignKeyId")


def with_change(now: Column, before: Column | None) -> Column:
    """``n``, followed by ``  (+d)`` or ``  (-d)`` if there is something to compare and it moved."""
    now = F.coalesce(now, F.lit(0))
    text = now.cast("string")
    if before is None:
        return text
    change = now - F.coalesce(before, F.lit(0))
    return F.when(change == 0, text).otherwise(
        F.concat(text, F.format_string(CHANGE, change.cast("long")))
    )


def fk_result(
    errors: DataFrame, foreign_keys: DataFrame, run: int, comparison: int | None = None
) -> DataFrame:
    """Counts of one run for every key that ever failed, with the change since another run."""

    def of(run_id: int, suffix: str) -> DataFrame:
        return errors.where(F.col("RunId") == run_id).select(
            "ForeignKeyId",
            F.col("Count").alias(f"Count{suffix}"),
            F.col("DistinctCount").alias(f"DistinctCount{suffix}"),
        )

    rows = failed_keys(errors, foreign_keys).join(of(run, "_now"), "ForeignKeyId", "left")
    if comparison is not None:
        rows = rows.join(of(comparison, "_then"), "ForeignKeyId", "left")

    def text(name: str) -> Column:
        before = None if comparison is None else F.col(f"{name}_then")
        return with_change(F.col(f"{name}_now"), before).alias(name)

    return rows.select(*FK_COLUMNS, text("Count"), text("DistinctCount"))


def select_runs(
    runs: DataFrame,
    practices: DataFrame,
    *,
    cdb: int | None = None,
    group: int | None = None,
    comparison_group: int | None = None,
    use_name: bool = False,
) -> DataFrame:
    """``RunId, ComparisonRunId, Header, OrderBy`` of the runs a report shows.

    A header that two columns share gets the run id added, and the id of the run it is compared with
    if there is one, since every column of the report needs its own name.
    """
    if cdb is None and group is None:
        raise ValueError("give a practice number (cdb) or a run group")
    chosen = runs if group is None else runs.where(F.col("RunGroupId") == group)
    about = practices.select("PracticeDBName", "CDB", "PracticeName", "StartExtractId")
    if cdb is not None:
        about = about.where(F.col("CDB") == cdb)
    rows = chosen.join(about, "PracticeDBName", "left" if cdb is None else "inner")
    if comparison_group is None:
        rows = rows.withColumn("ComparisonRunId", F.lit(None).cast("int"))
    else:
        then = runs.where(F.col("RunGroupId") == comparison_group).select(
            "PracticeDBName", F.col("RunId").alias("ComparisonRunId")
        )
        rows = rows.join(then, "PracticeDBName", "left")
    if use_name:
        label = F.substring("PracticeName", 1, NAME_LENGTH)
    else:
        label = F.concat(F.lit("CDB"), F.col("CDB").cast("string"))
    header = F.concat(label, F.lit("-Ext"), F.col("ExtractId").cast("string"))
    same = Window.partitionBy("_header")
    # One row per validation run: a global order over a handful of rows.
    order = Window.orderBy("StartExtractId", "PracticeName", "RunId", "ComparisonRunId")
    return (
        rows.withColumn("_header", header)
        .withColumn(
            "Header",
            F.when(F.count("*").over(same) == 1, F.col("_header")).otherwise(
                F.concat_ws(
                    " #",
                    "_header",
                    F.col("RunId").cast("string"),
                    F.col("ComparisonRunId").cast("string"),
                )
            ),
        )
        .withColumn("OrderBy", F.row_number().over(order))
        .select("RunId", "ComparisonRunId", "Header", "OrderBy")
    )


def fk_result_cells(
    errors: DataFrame, selected: DataFrame, *, distinct: bool = False
) -> DataFrame:
    """``ForeignKeyId, OrderBy, Cell``: what a report shows where a run or the one it is compared with failed.

    The report in its long form, without the cells that say ``0``; any number of runs.
    """
    measure = F.col("DistinctCount" if distinct else "Count").cast("long")

    def counts(run: str, now: Column, then: Column) -> DataFrame:
        by_run = errors.select(F.col("RunId").alias(run), "ForeignKeyId", measure.alias("_n"))
        chosen = selected.select(run, "OrderBy", F.col("ComparisonRunId").alias("_compared"))
        return chosen.join(by_run, run).select(
            "ForeignKeyId", "OrderBy", F.col("_compared").isNotNull().alias("_compared"),
            now.alias("_now"), then.alias("_then"),
        )

    nothing = F.lit(0).cast("long")
    both = counts("RunId", F.col("_n"), nothing).unionByName(
        counts("ComparisonRunId", nothing, F.col("_n"))
    )
    summed = both.groupBy("ForeignKeyId", "OrderBy", "_compared").agg(
        F.sum("_now").alias("_now"), F.sum("_then").alias("_then")
    )
    now, then = F.col("_now"), F.col("_then")
    cell = F.when(F.col("_compared"), with_change(now, then)).otherwise(with_change(now, None))
    return summed.select("ForeignKeyId", "OrderBy", cell.alias("Cell"))


def fk_results_listed(
    errors: DataFrame,
    foreign_keys: DataFrame,
    selected: DataFrame,
    *,
    distinct: bool = False,
    length: int | None = None,
) -> DataFrame:
    """The report with all runs in one column: one row per key that ever failed, ``Cells`` in run order.

    ``length`` is the number of runs, counted if it is not given. The cells of a key are sorted once and
    the runs between them filled with ``0``: the work grows with the cells, the plan not at all. A row
    holds one cell per run, as a line of the report does.
    """
    length = selected.count() if length is None else length
    cells = (
        fk_result_cells(errors, selected, distinct=distinct)
        .groupBy("ForeignKeyId")
        .agg(F.array_sort(F.collect_list(F.struct("OrderBy", "Cell"))).alias("_found"))
    )
    # One more entry behind the last run closes the row; it is cut off again.
    end = F.struct(F.lit(length + 1).alias("OrderBy"), F.lit("").alias("Cell"))
    found = F.concat(F.coalesce("_found", F.array().cast(FOUND)), F.array(end))
    filled = F.transform(
        "_closed",
        lambda entry, i: F.concat(
            F.array_repeat(
                F.lit("0"),
                entry["OrderBy"] - F.when(i > 0, F.get("_closed", i - 1)["OrderBy"]).otherwise(0) - 1,
            ),
            F.array(entry["Cell"]),
        ),
    )
    return (
        failed_keys(errors, foreign_keys)
        .join(cells, "ForeignKeyId", "left")
        .withColumn("_closed", found)
        .select(*FK_COLUMNS, F.slice(F.flatten(filled), 1, length).alias("Cells"))
    )


FOUND = "array<struct<OrderBy:int,Cell:string>>"


def fk_results(
    errors: DataFrame, foreign_keys: DataFrame, selected: DataFrame, *, distinct: bool = False
) -> DataFrame:
    """The report: one row per key that ever failed, one column per selected run, in run order.

    Columns are made last, from the listed cells; a frame of more than a few thousand columns is slow to
    plan, whatever is in it. Use :func:`fk_results_listed` or :func:`report_text` there.
    """
    headers = [r.Header for r in selected.orderBy("OrderBy").select("Header").collect()]
    rows = fk_results_listed(
        errors, foreign_keys, selected, distinct=distinct, length=len(headers)
    )
    columns = [F.get("Cells", F.lit(i)).alias(header) for i, header in enumerate(headers)]
    return rows.select(*FK_COLUMNS, *columns).orderBy(*FK_COLUMNS)


def report_text(listed: DataFrame, selected: DataFrame, separator: str = "\t") -> DataFrame:
    """The report as lines (``LineId, Line``), the headers first: for a file, with any number of runs."""
    headers = selected.agg(
        F.array_sort(F.collect_list(F.struct("OrderBy", "Header")))["Header"].alias("Cells")
    ).select(*[F.lit(c).alias(c) for c in FK_COLUMNS], "Cells", F.lit(0).alias("_part"))
    lines = headers.unionByName(listed.withColumn("_part", F.lit(1)))
    # One row per foreign key of the registry.
    order = Window.orderBy("_part", *FK_COLUMNS)
    cells = F.concat(F.array(*FK_COLUMNS), F.col("Cells"))
    return lines.select(
        (F.row_number().over(order) - 1).alias("LineId"),
        F.array_join(cells, separator, "").alias("Line"),
    )
