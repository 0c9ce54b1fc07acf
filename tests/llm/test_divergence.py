import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import divergence
from tidemark.llm.common import word_places
from tidemark.llm.divergence import TERM, _share, equal_runs, source_divergence

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return LETTERS.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(rows, least=10, top=10):
    """Python integers all the way; rows of (doc_id, text, lang, source)."""
    said, holding, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        said[lang, source].update(terms(text))
        holding[lang].update(set(terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in holding[lang].items() if n >= least]

        def shares(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        whole = shares(sum((said[lang, s] for s in sources), Counter()))
        own = {s: shares(said[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum((own[s][t] - own[o][t]) ** 2 // (own[s][t] + own[o][t]) for t in kept)) for o in sources - {s}]
            more = [(t, (own[s][t] - whole[t]) ** 2 // (own[s][t] + whole[t])) for t in kept if said[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", more, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbBé😀 -\x00", max_size=40), min_size=1, max_size=6))
def test_runs_are_the_words(texts):
    data = [t.encode() for t in texts]
    letters = TERM[np.frombuffer(b"".join(data) or b" ", np.uint8)]
    offsets = np.cumsum([0] + [len(d) for d in data])
    starts, lengths = word_places(letters != 0, offsets)
    assert [bytes(letters[s : s + n]).decode() for s, n in zip(starts, lengths, strict=True)] == [w for t in texts for w in terms(t)]
    order, opens = equal_runs(letters, starts, lengths)
    words = [bytes(letters[starts[i] : starts[i] + lengths[i]]) for i in order]
    assert words == sorted(words)
    assert opens.tolist() == [i == 0 or words[i] != words[i - 1] for i in range(len(words))]


def test_words_that_share_long_openings():
    words = ["abcdefgh", "abcdefghi", "abcdefghabcdefgh", "abcdefghabcdefghz", "abcdefg", "abcdefgh", "é" * 30, "é" * 29] * 3
    data = TERM[np.frombuffer(" ".join(words).encode(), np.uint8)]
    starts, lengths = word_places(data != 0, np.array([0, len(data)]))
    order, opens = equal_runs(data, starts, lengths)
    found = [bytes(data[starts[i] : starts[i] + lengths[i]]).decode() for i in order]
    assert found == sorted(words, key=str.encode) and opens.sum() == len(set(words))


@pytest.fixture
def several(prose):
    rows = []
    for i in range(400):
        lang = ("en", "en", "de", None)[i % 4]
        source = None if i % 7 == 3 else f"src{i % 5}"
        rows.append((i, " ".join(prose(30 + i % 50, i % 60)).title() + " Éa-b9c", lang, source))
    rows += [(900, "rare words only", "fr", "a"), (901, None, "fr", "b"), (902, "", "fr", None), (None, "12 34", "xx", "src0")]
    return rows + rows[:40]


def test_against_brute_force(table, several):
    found = sorted(tuple(r) for r in source_divergence(table(several)).collect())
    assert found == brute(several)
    assert {r[2] for r in found} == {"pair", "term"}


def test_blocks_and_tiles_do_not_matter(table, several, monkeypatch):
    for name, value in (("BLOCK", 7), ("TILE", 2), ("ENTRIES", 5), ("SLICE", 300)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(tuple(r) for r in source_divergence(table(several)).collect()) == brute(several)


def test_edges(table, edge_rows, rows):
    docs = table(edge_rows)
    want = brute(edge_rows, least=2)
    assert sorted(tuple(r) for r in source_divergence(docs, least=2).collect()) == want
    clashing = docs.withColumns({c: F.lit("x") for c in ("term", "n", "docs", "p", "q", "block", "tile", "part", "item", "rank", "total")})
    assert sorted(tuple(r) for r in source_divergence(clashing, least=2).collect()) == want
    assert source_divergence(table([])).collect() == []


def test_shares_are_exact(spark):
    cases = [(0, 1), (0, 2), (7, 13), (2**62, 2**62 + 5), (2**55 + 1, 2**62), (999_999_999_999, 10**15 + 37), (0, 0)]
    df = spark.createDataFrame(cases, "n long, total long")
    found = df.select("n", "total", _share(F.col("n"), F.col("total")).alias("p")).collect()
    assert all(r["p"] == (1 + 10**9 * (r["n"] + 2) // r["total"] if r["total"] else 1) for r in found)
