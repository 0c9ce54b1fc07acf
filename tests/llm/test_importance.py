import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import importance
from tidemark.llm.importance import BUCKETS, EVIDENCE, gram_buckets, resampled, with_top

GIVEN = "/root/testdata/sf0.01"


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_same_as_brute_force(spark, table, prose, edge_rows):
    rows = [(i, " ".join(prose(60, i)) + (" *** $$$" * 20 if i % 3 == 0 else ".")) for i in range(90)]
    rows = [(10000 + d if d is not None else None, t) for d, t, *_ in edge_rows] + rows
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 60)] + [(61, 1, 1), (10**9, 1, 0), (None, 1, 0)]
    docs = table(rows).withColumns({c: F.lit(1) for c in ("key", "kept", "score", "target", "__good")}).repartition(5)
    found = resampled(docs, labelled(spark, labels)).collect()

    good = {d for d, q, t in labels if q == 1 and not t and d is not None}
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for d, t in rows:
        np.add.at(raw, gram_buckets(t), 1)
        if d in good:
            np.add.at(target, gram_buckets(t), 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    mean = lambda t: None if not len(gram_buckets(t)) else ratio[gram_buckets(t)].mean()
    want = sorted(((str(d), mean(t)) for d, t in rows), key=str)
    have = sorted(((str(r.doc_id), r.log_ratio) for r in found), key=str)
    assert len(want) == len(have)
    for (d, a), (e, b) in zip(want, have):
        assert d == e and ((a is None and b is None) or abs(a - b) < 1e-9)
    ids = {d for d, q, t in labels if d is not None}
    k = int(np.ceil(sum(q == 1 for d, q, t in labels if d is not None) / len(ids) * len(rows)))
    order = sorted(found, key=lambda r: (-r.key, r.doc_id is None, r.doc_id))
    assert sum(r.kept for r in found) == k and {r.key for r in found if r.kept} == {r.key for r in order[:k]}
    assert all((r.score == 0) == (r.n_grams == 0) and 0 <= r.score <= 1 for r in found)


def test_noise_is_gumbel(spark):
    found = spark.range(20000).select(importance.noise(F.col("id")).alias("g")).agg(F.avg("g"), F.var_samp("g")).first()
    assert abs(found[0] - 0.5772) < 0.03 and abs(found[1] - np.pi**2 / 6) < 0.1


def test_draws_follow_the_weights(spark, monkeypatch):
    """Of two weights one e times the other, the heavier is drawn first that often."""
    wins = spark.range(0, 20000, 2).select((importance.noise(F.col("id")) + 1 > importance.noise(F.col("id") + 1)).cast("int").alias("w"))
    assert abs(wins.agg(F.avg("w")).first()[0] - np.e / (1 + np.e)) < 0.015


def test_top_by_parts(spark, monkeypatch):
    monkeypatch.setattr(importance, "FEW", 5)
    monkeypatch.setattr(importance, "FINE", 7)
    keys = [(i, float((i * 7919) % 1000) / 3) for i in range(1000)] + [(2000 + i, 100.0) for i in range(50)] + [(3000, -1e9), (None, 50.0)]
    df = spark.createDataFrame(keys, "doc_id long, key double")
    order = sorted(keys, key=lambda r: (-r[1], r[0] is None, r[0]))
    for k in (0, 1, 10, 500, 690, 700, 715, 1051, 1052, 2000):
        found = with_top(df, k).collect()
        assert len(found) == len(keys) and {r.doc_id for r in found if r.kept} == {d for d, _ in order[:k]}, k


def test_many_equal_keys_are_cut_by_id(spark, monkeypatch):
    """A third of the rows have the key at the edge: no task orders more than a few of them."""
    monkeypatch.setattr(importance, "FEW", 20)
    monkeypatch.setattr(importance, "FINE", 16)
    ids = [-(2**63), 2**63 - 1, 0, None, None, *range(5, 20000, 23), *range(-(2**62), 2**62, 2**54)]
    keys = [(d, -1e9) for d in ids] + [(10**6 + i, i / 7) for i in range(2 * len(ids))]
    df = spark.createDataFrame(keys, "doc_id long, key double").repartition(4)
    order = sorted(keys, key=lambda r: (-r[1], r[0] is None, r[0]))
    counted = []
    narrowed = importance._narrowed
    monkeypatch.setattr(importance, "_narrowed", lambda *a: counted.append(narrowed(*a)) or counted[-1])
    for more in (1, 2, 300, len(ids) - 3, len(ids) - 1):
        k = 2 * len(ids) + more
        found = with_top(df, k).collect()
        assert len(found) == len(keys)
        assert sorted((r.doc_id for r in found if r.kept), key=repr) == sorted((d for d, _ in order[:k]), key=repr)
        assert counted[-1][3] <= 20, "few rows are ordered"


def test_good_documents_are_told_from_junk(spark):
    docs, labels = (spark.read.parquet(f"{GIVEN}/{t}.parquet") for t in ("documents", "labels"))
    found = resampled(docs, labels).join(labels, "doc_id").collect()
    clean = [r for r in found if r.quality == 1]
    junk = [r for r in found if r.quality == 0]
    assert sum(r.kept for r in clean) > 0.95 * len(clean) and sum(r.kept for r in junk) < 0.3 * len(junk), (
        sum(r.kept for r in clean), len(clean), sum(r.kept for r in junk), len(junk))


def test_no_labels_and_empty_tables(spark, table, edge_rows):
    none = labelled(spark, [])
    assert all(r.kept for r in resampled(table(edge_rows), none).collect())
    assert resampled(table([]), none).count() == resampled(table([]), labelled(spark, [(1, 1, 0)])).count() == 0
    assert EVIDENCE > 0
