"""For which extracts each version of a row holds.

A version of a key holds from the extract it came with until the next version of that key. With that end
beside every row, the state as of any extract and the difference between any two are filters: the
newest versions need not be looked for again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.versioned import compared, not_deleted
from tidemark.registry import VERSION

#: The extract that replaced a version; null while it is the newest.
UNTIL = "ReplacedIn"


def with_validity(
    history: DataFrame, keys: Sequence[str], *, version: str = VERSION
) -> DataFrame:
    """Every row of a history with the extract that replaced it, for all extracts in one pass.

    The versions of a key are first reduced to one row per extract, so that what is sorted for one key is never
    more than there are extracts, however many rows it has. Those pairs meet the rows by key and version in a join of
    plain shuffles, which is split at run time for a key with a large share of the rows. Rows with a null
    key part hold in no extract and are left out, as everywhere; copies of a row all stay.
    """
    keys = list(keys)
    arrivals = history.select(*keys, version).dropna().distinct()
    following = Window.partitionBy(*keys).orderBy(version)
    spans = arrivals.withColumn(UNTIL, F.lead(version).over(following))
    return history.join(spans, [*keys, version]).select(*history.columns, UNTIL)


def holding(intervals: DataFrame, extract: int, *, version: str = VERSION) -> DataFrame:
    """The rows that hold as of an extract, deleted ones included."""
    still = F.col(UNTIL).isNull() | (F.col(UNTIL) > extract)
    return intervals.where((F.col(version) <= extract) & still)


def as_of_intervals(
    intervals: DataFrame, extract: int, deleted: str | None = None, *, version: str = VERSION
) -> DataFrame:
    """The state as of an extract, as :func:`~tidemark.operators.versioned.as_of` gives it."""
    return not_deleted(holding(intervals, extract, version=version), deleted).drop(UNTIL)


def diff_of_intervals(
    intervals: DataFrame,
    keys: Sequence[str],
    before: int,
    after: int,
    *,
    deleted: str | None = None,
    ignore: Sequence[str] = (),
    version: str = VERSION,
) -> DataFrame:
    """Keys added, removed or changed between two extracts, as ``extract_diff`` gives them.

    What held before and was replaced by the later extract is compared with what came in between and
    still holds then; rows that hold in both are never looked at.
    """
    if before >= after:
        raise ValueError("the first extract must be earlier than the second")
    own = {*keys, *ignore, version, UNTIL}
    payload = [c for c in intervals.columns if c not in own]
    old = holding(intervals, before, version=version).where(F.col(UNTIL) <= after)
    new = holding(intervals, after, version=version).where(F.col(version) > before)
    return compared(not_deleted(old, deleted), not_deleted(new, deleted), list(keys), payload)
