import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import shingle_set
from tidemark.llm.components import components
from tidemark.llm.ngram_join import _bands, connecting_links, lane_keys, linked_documents, one_of_each


def brute(rows, width=5, num=80, den=100):
    """doc_id -> (set size, smallest linked doc_id) by comparing every pair."""

    def shingles(text):
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).replace("\n", " ").replace("\t", " ").split(" ") if w]
        return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()

    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        return i if top[i] == i else find(top[i])

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(s), str(least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near_copies(prose, seed=3):
    rng, rows = random.Random(seed), []
    for g, n in enumerate([4, 5, 6, 7, 9, 12, 20, 33, 64, 80, 120, 150, 260, 300, 700]):
        base = prose(n, 100 + g)
        for c in range(8):
            words = list(base)
            for _ in range(rng.randint(0, max(1, n // 40))):
                words[rng.randrange(len(words))] = rng.choice("xyz") * 3
            if rng.random() < 0.4:
                words = words + prose(rng.randint(0, n // 5 + 1), rng.random())
            text = (" " if c % 2 else "\n").join(words)
            rows.append((1000 - len(rows), text.upper() if c == 3 else text))
    return rows


def test_same_components_as_comparing_every_pair(table, prose, edge_rows):
    rows = near_copies(prose) + [r[:2] for r in edge_rows]
    found = linked_documents(table(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows)


def test_many_near_copies_without_all_pairs(table, prose):
    """A group whose copies mostly link through others, in several blocks."""
    rng, base = random.Random(9), prose(60, 1)
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(60)] = f"w{rng.randrange(40)}"
        if rng.random() < 0.3:
            words[rng.randrange(60)] = f"v{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    found = linked_documents(table(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows)


def test_blocks_find_the_same(table, prose, monkeypatch):
    import tidemark.llm.ngram_join as module

    rows = near_copies(prose, 8)
    monkeypatch.setattr(module, "BLOCK", 300)
    found = linked_documents(table(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows)


@pytest.mark.parametrize("threshold", [(80, 100), (60, 100), (95, 100)])
def test_linked_sets_share_a_lane(threshold):
    num, den = threshold
    rng = np.random.default_rng(4)
    for n in [*range(2, 70), 100, 127, 128, 129, 160, 255, 300, 511, 520, 1300]:
        for _ in range(25):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            cut = rng.integers(0, len(a))
            most = (len(a) * 2 - cut) * (den - num) // (den + num)
            b = np.unique(np.r_[a[cut:], rng.integers(0, 2**63, max(0, int(rng.integers(0, n // 3 + 2)))).astype(np.uint64)])
            if den * len(np.intersect1d(a, b)) < num * len(np.union1d(a, b)) or np.array_equal(a, b):
                continue
            with np.errstate(over="ignore"):
                shared = [g for g in _bands(len(a), threshold) if g in _bands(len(b), threshold) and np.intersect1d(lane_keys(a, g, threshold), lane_keys(b, g, threshold)).size]
            assert shared, (n, len(a), len(b), most)


def test_connecting_links_are_links():
    sets = {i: np.arange(i, i + 50, dtype=np.uint64) for i in range(0, 40, 2)}
    found = connecting_links(sets, (80, 100))
    assert found == [(0, i) for i in range(2, 40, 2)]


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    edges = spark.createDataFrame(path + star + [(5, 5), (1001, 1000), (3000, 2000)], "a long, b long")
    found = {r.vertex: r.root for r in components(edges).collect()}
    assert all(found[i] == 0 for i in range(201))
    assert all(found[i] == 1000 for i in range(1000, 1400))
    assert found[3000] == found[2000] == 2000
    assert len(found) == 201 + 400 + 2
    assert components(edges.limit(0)).count() == 0


def test_empty_table_and_clashing_columns(table, prose):
    empty = table([])
    assert linked_documents(empty).count() == 0
    rows = near_copies(prose)[:16]
    docs = table(rows).withColumns({c: F.lit("x") for c in ("node", "n_shingles", "component_id", "key", "part", "id", "a", "b", "mark", "given", "n", "root", "first", "__id", "__mark")})
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute(rows)}
    assert {str(r.doc_id) for r in kept.collect()} == want


def test_rows_without_id(table):
    text = "one two three four five six seven eight"
    rows = [(None, text), (7, text), (None, "a lonely text without any id at all"), (None, None)]
    found = sorted((str(r.doc_id), str(r.component_id)) for r in linked_documents(table(rows)).collect())
    assert found == [("7", "7"), ("None", "7"), ("None", "None"), ("None", "None")]


def test_one_of_each_without_ids(table):
    """A row without an id goes with the linked one that has one; near copies under one id are one document."""
    text = "one two three four five six seven eight"
    rows = [(None, text), (7, text), (None, "a lonely text without any id at all"), (None, None), (3, "x y"), (3, text + " nine")]
    left = sorted((str(r.doc_id), str(r.text)) for r in one_of_each(table(rows)).collect())
    assert left == sorted([("None", "None"), ("None", rows[2][1]), ("3", "x y"), ("3", text + " nine")])


def test_one_of_each_of_a_table_loaded_twice(spark, table, prose):
    rows = near_copies(prose) + [(None, " ".join(prose(40, 77)), None, "a"), (5000, "", "en", "a"), (5001, " ".join(prose(50, 78)), "de", "b")]
    docs = table(rows)
    once = sorted(map(tuple, one_of_each(docs).collect()), key=repr)
    other = docs.where("doc_id = 5001").withColumn("source", F.lit("c"))
    left = sorted(map(tuple, one_of_each(docs.unionByName(docs).unionByName(docs).unionByName(other)).collect()), key=repr)
    blank = [r for r in once if r[0] == 5000]
    assert left == sorted(once + 2 * blank, key=repr), "of equal id and text any one, here the least; rows without words all stay"


def test_shingles_of_short_and_blank_texts():
    assert [len(shingle_set(t, 5)) for t in (None, "", " \n", "a", "a b c d e", "a b c d e f")] == [0, 0, 0, 1, 1, 2]
    assert np.array_equal(shingle_set("AÉ b", 5), shingle_set("aÉ  b", 5))
    assert not np.array_equal(shingle_set("É", 5), shingle_set("é", 5))
