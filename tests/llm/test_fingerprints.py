import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.fingerprints import CEILING, as_text, containment, edited_fingerprints, fingerprint, likeness, merged, next_ids


def edited(rows):
    """doc_id, n_chars, digest of the edited text by plain loops; ids distinct."""
    order = sorted((d for d, _ in rows if d is not None), reverse=True)
    texts = {d: t or "" for d, t in rows}
    out = []
    for d, t in rows:
        t = t or ""
        n = len(t) // 3
        other = "" if d is None else texts[order[(order.index(d) + 1) % len(order)]]
        out.append((str(d), len(t), hashlib.sha256((t[: len(t) - n] + other[:n]).encode()).hexdigest()))
    return sorted(out)


def test_edited_texts(table, prose):
    rows = [(i * i - 50, " ".join(prose(5 + i * 7 % 90, i)) + "é😀ß"[: i % 4] * i) for i in range(60)]
    rows += [(5000, None), (5001, ""), (None, "one two three four five six")]
    docs = table(rows).withColumns({c: F.lit(1) for c in ("to", "n", "start", "part", "next_id", "sketch")})
    found = edited_fingerprints(docs.repartition(7))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found.collect()) == edited(rows)


def test_likeness_follows_the_true_one(table, prose):
    rows = [(i, " ".join(prose(900, i))) for i in range(0, 30)]
    rows += [(100 + i, rows[i][1] + " " + " ".join(prose(30, 500 + i))) for i in range(30)]
    rows.sort(key=lambda r: (r[0] % 100, r[0]))
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    found = {r.doc_id: r for r in edited_fingerprints(table(rows)).collect()}
    for i in range(60):
        assert 0.3 < found[i].near_edited < 0.75
        assert (found[i].near_next > 0.85) == (i % 2 == 1)
        assert i % 2 == 1 or found[i].near_next < 0.05


def test_sketches_merge_and_contain(spark, prose):
    a, b = prose(3000, 1), prose(40, 2)
    rows = [(" ".join(a), " ".join(b), " ".join(a + b), " ".join(a[500:800]))]
    df = spark.createDataFrame(rows, "a string, b string, ab string, part string")
    f = {c: fingerprint(F.col(c)) for c in df.columns}
    got = df.select(
        F.array_except(merged(f["a"], f["b"]), f["ab"]).alias("more"),
        F.size(F.array_except(f["ab"], merged(f["a"], f["b"]))).alias("across"),
        containment(f["part"], f["a"]).alias("inside"),
        containment(f["a"], f["part"]).alias("outside"),
        F.size(f["a"]).alias("n"),
        F.array_max(f["a"]).alias("top"),
    ).first()
    assert got.more == [] and got.across <= 4 and got.inside == 1.0 and got.outside < 0.2
    assert 2996 / 8 * 0.7 < got.n < 2996 / 8 * 1.3 and got.top < CEILING


def test_edges(table, edge_rows):
    found = edited_fingerprints(table(edge_rows))
    rows = found.select("*", as_text(F.col("sketch")).alias("t")).collect()
    assert len(rows) == len(edge_rows)
    by = {}
    for r in rows:
        by.setdefault(str(r.doc_id), []).append(r)
    assert by["1"][0].t == by["2"][0].t == by["3"][0].t == "" and by["2"][0].near_next == 1.0
    assert by["4"][0].t == by["5"][0].t and by["5"][0].near_next == 1.0
    assert sorted(r.n_chars for r in by["6"]) == [3, 3, 25] and by["None"][0].near_next is None
    assert all(0 <= r.near_edited <= 1 for r in rows)
    assert edited_fingerprints(table([])).count() == 0
    one = edited_fingerprints(table([(3, "a b c d e f")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"a b c d a b").hexdigest()


def test_next_ids_over_many_parts(spark):
    ids = [3 * i for i in range(500)] + [-7, 10**12]
    df = spark.createDataFrame([(i,) for i in ids + ids[:5] + [None]], "doc_id long").repartition(9)
    order = sorted(ids, reverse=True)
    assert {r.doc_id: r.next_id for r in next_ids(df).collect()} == {a: b for a, b in zip(order, order[1:] + order[:1])}


@pytest.mark.parametrize("pair", [("", ""), ("a b", ""), ("x", "x")])
def test_likeness_of_small_texts(spark, pair):
    df = spark.createDataFrame([pair], "a string, b string")
    got = df.select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("l")).first().l
    assert got == (1.0 if pair[0] == pair[1] else 0.0)
