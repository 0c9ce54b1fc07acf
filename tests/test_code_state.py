import random
from datetime import datetime, timedelta

import pytest

from tests import extracts as x
from tidemark.care_records import CARE_RECORDS
from tidemark.operators.analytics import code_counts_by_practice, text_date
from tidemark.operators.code_state import CODE_COUNTS, code_counts_after
from tidemark.operators.versioned import as_of
from tidemark.plans.code_counts import stored_code_counts, update_code_counts
from tidemark.plans.install import install_all
from tidemark.registry import PRACTICE, Table
from tidemark.sources import history as store

SCHEMA = "k string, CodeId string, EffectiveDate timestamp_ntz, Deleted string, practice string, ExtractId int"
COLUMNS = ["practice", "CodeId", "MostRecentDate", "CodeCount"]
DAY = datetime(2020, 1, 1)


def data(seed, size=300):
    """Keys sent again with other codes and dates, copies, deletions, null keys, codes and dates."""
    pick = random.Random(seed)
    return [
        (
            pick.choice([f"k{pick.randrange(40)}", None, "k0"]),
            pick.choice(["a", "b", "c", None]),
            pick.choice([DAY + timedelta(days=pick.randrange(5)), None]),
            pick.choice(["false", "false", "true", None]),
            pick.choice("PQ"),
            pick.randrange(1, 6),
        )
        for _ in range(size)
    ]


def brute(rows, n, keyed):
    """practice, code -> count and latest date, from the requirement."""
    newest = {}
    for k, _, _, _, p, e in rows:
        if e <= n:
            newest[p, k] = max(newest.get((p, k), 0), e)
    counts = {}
    for k, c, d, deleted, p, e in rows:
        stands = e == newest.get((p, k)) and k is not None if keyed else e <= n
        if stands and deleted == "false" and c is not None:
            number, latest = counts.get((p, c), (0, None))
            counts[p, c] = number + 1, max((v for v in (latest, d) if v), default=None)
    return counts


@pytest.mark.parametrize("keys", [("k",), ()])
@pytest.mark.parametrize("seed", [1, 2])
def test_after_every_extract_as_if_counted_afresh(spark, keys, seed):
    rows = data(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    table = Table("t", PRACTICE, keys, deleted="Deleted")
    counts = spark.createDataFrame([], CODE_COUNTS)
    for n in range(1, 6):
        found = code_counts_after(counts, df, table, n).collect()
        expected = brute(rows, n, bool(keys))
        assert {(r.practice, r.CodeId): (r.CodeCount, r.MostRecentDate) for r in found} == expected
        assert len(found) == len(expected)
        counts = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in found], CODE_COUNTS)


def test_the_last_row_of_a_code_goes(spark):
    table = Table("t", PRACTICE, ("k",), deleted="Deleted")
    df = spark.createDataFrame(
        [("1", "a", DAY, "false", "P", 1), ("1", "a", DAY, "true", "P", 2)], SCHEMA
    )
    none = spark.createDataFrame([], CODE_COUNTS)
    first = code_counts_after(none, df, table, 1).collect()
    assert [(r.CodeId, r.CodeCount) for r in first] == [("a", 1)]
    state = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in first], CODE_COUNTS)
    assert code_counts_after(state, df, table, 2).collect() == []
    assert code_counts_after(none, df.limit(0), table, 1).collect() == []


def test_store(spark, tmp_path, monkeypatch):
    """After each install the stored counts are those of the whole state; a broken update is done again."""
    root, folder = str(tmp_path / "store"), str(tmp_path / "in")
    x.write_extract(f"{folder}/e1", "1-100", "20170101020000", x.bulk())
    x.write_extract(f"{folder}/e2", "101-150", "20170108020000", x.delta(), line_end="\n")
    x.write_extract(f"{folder}/e3", "1-40", "20170115020000", x.delta_with_new_practice(), guid=x.GUID.lower())
    name = "CareRecord_Observation"
    for extract in (1, 2, 3):
        install_all(spark, root, f"{folder}/e{extract}")
        if extract == 2:
            write = store.write_batch

            def broken(df, at, what, batch):
                write(df, at, what, batch)
                if what == "CodeCounts":
                    raise RuntimeError("lost")

            monkeypatch.setattr(store, "write_batch", broken)
            with pytest.raises(RuntimeError):
                update_code_counts(spark, root, name)
            monkeypatch.setattr(store, "write_batch", write)
        assert update_code_counts(spark, root, name) == [extract]
        assert update_code_counts(spark, root, name) == []
    about = store.read_layout(spark, root, CARE_RECORDS).table(name)
    history = store.read_history(spark, root, about)
    for extract in (1, 2, 3):
        whole = code_counts_by_practice(as_of(history, about, extract), date=text_date("EffectiveDate"))
        stored = stored_code_counts(spark, root, name, extract)
        assert sorted(map(repr, whole.select(*COLUMNS).collect())) == sorted(
            map(repr, stored.select(*COLUMNS).collect())
        )
    assert stored_code_counts(spark, root, name).count() > 0
