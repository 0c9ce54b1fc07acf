"""Code counts that follow the extracts.

The counts as of an extract are those as of the one before, plus the rows that came, less the rows they
replaced. Counts add up; a latest date does not once its row is gone, so it is looked for again, but only for the
codes that lost theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.versioned import newest_versions, not_deleted, rows_of_versions, up_to
from tidemark.registry import TENANT, VERSION, Table
from tidemark.sources.shared import written_once

#: The counts kept: one row per practice and code in use.
CODE_COUNTS = f"{TENANT} string, CodeId string, MostRecentDate timestamp_ntz, CodeCount long"


def code_counts_after(
    state: DataFrame,
    history: DataFrame,
    table: Table,
    extract: int,
    code: str = "CodeId",
    date: str | Column = "EffectiveDate",
) -> DataFrame:
    """Uses and latest use of every code per practice as of an extract.

    ``state`` (columns as in ``CODE_COUNTS``) holds the same as of the extract before, ``history`` all versions up to
    this one at least, or a saved state and what followed it. The result is what a count of the whole state as of
    the extract gives. Rows without a code are in no count; codes whose last row went are not listed. A key sent
    again by the extract replaces all its older rows, a deleted one takes them away; tables without a key only grow.

    Only the keys that the extract brings are looked up in the history, by a semi join that needs no
    shuffle of the history where those keys are few; their older versions are found from the key columns alone, the
    rows picked by them, and dates read of no other row. The changes per code are written once, since both the codes that keep their date and those that
    look for a new one are taken from them; where no code lost its date, the history is not read again.
    """
    columns = [TENANT, "CodeId", "MostRecentDate", "CodeCount"]
    when = F.col(date) if isinstance(date, str) else date
    # The practice, which starts the keys, goes last: a sort tells rows apart by the first column if it can.
    keys = table.scoped_keys(history.columns)[::-1]
    uses = {"_practice": F.col(TENANT), "_code": F.col(code).cast("string")}
    dates = {"_date": when.cast("timestamp_ntz")}
    rows = up_to(history, extract)

    def signed_rows(found: DataFrame, sign: int) -> DataFrame:
        counted = not_deleted(found, table.deleted).withColumns(uses | dates).where("_code is not null")
        return counted.select("_practice", "_code", "_date", F.lit(sign).alias("_sign"))

    came = rows.where(F.col(VERSION) == extract)
    signed = signed_rows(came.dropna(subset=keys) if keys else came, 1)
    if keys:
        earlier = rows.where(F.col(VERSION) < extract)
        replaced = earlier.select(*keys, VERSION).join(
            came.select(*keys).distinct(), keys, "left_semi"
        )
        gone = rows_of_versions(earlier, newest_versions(replaced, keys), keys)
        signed = signed.unionByName(signed_rows(gone, -1))
    changes = signed.groupBy("_practice", "_code").agg(
        F.sum("_sign").alias("_change"),
        F.max(F.when(F.col("_sign") > 0, F.col("_date"))).alias("_came"),
        F.max(F.when(F.col("_sign") < 0, F.col("_date"))).alias("_gone"),
    )
    same = (F.col(TENANT) == F.col("_practice")) & (F.col("CodeId") == F.col("_code"))
    updated = state.select(*columns).join(changes, same, "full").select(
        F.coalesce(TENANT, "_practice").alias(TENANT),
        F.coalesce("CodeId", "_code").alias("CodeId"),
        F.greatest("MostRecentDate", "_came").alias("MostRecentDate"),
        (F.coalesce("CodeCount", F.lit(0)) + F.coalesce("_change", F.lit(0))).alias("CodeCount"),
        F.coalesce(
            (F.col("_gone") >= F.col("MostRecentDate"))
            & (F.col("_came").isNull() | (F.col("_came") < F.col("MostRecentDate"))),
            F.lit(False),
        ).alias("_lost"),
    )
    if not keys:
        return updated.select(*columns)
    updated = written_once(updated.where("CodeCount > 0"), "code-counts")
    if updated.where("_lost").isEmpty():
        return updated.select(*columns)
    lost = updated.where("_lost").select(
        F.col(TENANT).alias("_practice"), F.col("CodeId").alias("_code")
    )
    found = _latest_dates(rows.withColumns(uses), keys, table.deleted, lost, dates)
    dated = updated.where("_lost").drop("MostRecentDate").join(found, [TENANT, "CodeId"], "left")
    return updated.where("not _lost").select(*columns).unionByName(dated.select(*columns))


def _latest_dates(
    rows: DataFrame, keys: list[str], deleted: str | None, codes: DataFrame, dates: dict[str, Column]
) -> DataFrame:
    """The latest date of the given codes among the newest versions.

    A key whose newest version has another code counts for that one, so the versions of all keys that ever
    had one of the codes are compared.
    """
    holders = rows.join(codes, ["_practice", "_code"], "left_semi")
    versions = newest_versions(
        rows.join(holders.select(*keys).distinct(), keys, "left_semi"), keys
    )
    newest = not_deleted(rows_of_versions(holders, versions, keys), deleted).withColumns(dates)
    return newest.groupBy(
        F.col("_practice").alias(TENANT), F.col("_code").alias("CodeId")
    ).agg(F.max("_date").alias("MostRecentDate"))
