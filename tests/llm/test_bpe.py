import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import Vocabulary, digests, encoded, merge_order

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return Vocabulary(open(PATH, encoding="utf-8").read())


TEXTS = [
    "", " ", "Hello, World!! It's we'll THEY'RE don't 'd'm", "ÉCOLE Straße ΣΑΣ ΟΔΟΣ İstanbul", "é å Å",
    "<|startoftext|>a <|endoftext|><|endoftext|>b<|END|>", "1234 5.6 x²½", "日本語テキスト 한국어 ไทย 😀👍🏽 ‍", "a b c\u0085d\x1ce\x1ff\x0bg",
    "***%%%$$$ ## <|", "a" * 5000, "ab" * 3000 + "é" * 700, "\n\t x \r\n y", "'sss 'tt ''s",
]


@pytest.mark.parametrize("text", TEXTS)
def test_same_as_the_library(library, own, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == want
    assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_random_texts(library, own):
    rng = random.Random(5)
    letters = "abcdeéèßñÄÖΣσς'’ \n\t.,-<|>0129²*$日😀́ "
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_merges_like_repeated_search():
    rng = random.Random(1)

    def slow(symbols, ranks):
        symbols = list(symbols)
        while True:
            found = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
            if not found:
                return symbols
            _, i = min(found)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    for _ in range(400):
        pool, ranks = list("abc"), {}
        for r in range(rng.randint(0, 12)):
            pair = (rng.choice(pool), rng.choice(pool))
            if pair not in ranks:
                ranks[pair] = r
                pool.append(pair[0] + pair[1])
        word = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        assert merge_order(word, ranks) == slow(word, ranks)


def test_words_come_back(own):
    text = "the quick brown fox, ça va"
    assert own.text(own.encode(text)) == "the quick brown fox , ça va"


def test_query_digests(table, edge_rows, library):
    docs = table(edge_rows + [(50 + i, t) for i, t in enumerate(TEXTS)]).withColumns({c: F.lit("x") for c in ("ids", "decoded", "n_tokens")})
    found = digests(encoded(docs, PATH)).collect()
    want = []
    for d, t in [r[:2] for r in edge_rows] + [(50 + i, t) for i, t in enumerate(TEXTS)]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((str(d), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(want)
    assert encoded(table([]), PATH).count() == 0
