"""Byte-pair encoding and decoding of texts with a given vocabulary.

A word's symbols are the leaves of a segment tree over the ranks of adjacent pairs. Each leaf holds its pair's rank
and place as one number, each node the least of its two, so the root is the leftmost pair of the lowest
rank. A merge changes three leaves, and each change walks up the tree once: a word of n symbols
takes n log n steps, however long it is.

Words are few compared with their uses: each worker keeps what it has encoded, up to a fixed number of words.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

NONE = 1 << 62
#: Words that a worker remembers, and output bytes of one batch, about.
REMEMBERED, BATCH = 200_000, 1 << 23
#: White space as the vocabulary's own rules take it.
WHITE = r"\t-\r \x85\xa0  -     　"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def merge_order(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols after all merges: always the leftmost of the adjacent pairs with the lowest rank."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = list(symbols)
    width = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            tree[width + i] = rank * n + i
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))

    def put(i: int) -> None:
        j = after[i]
        rank = ranks.get((symbols[i], symbols[j])) if j < n else None
        i += width
        tree[i] = NONE if rank is None else rank * n + i - width
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            least = a if a < b else b
            if tree[i] == least:
                break
            tree[i] = least

    while tree[1] < NONE:
        i = tree[1] % n
        j = after[i]
        symbols[i] += symbols[j]
        symbols[j] = ""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        if j < n - 1:
            after[j] = n  # its pair is gone
            put(j)
        put(i)
        if before[i] >= 0:
            put(before[i])
    return [s for s in symbols if s]


class Vocabulary:
    """A vocabulary file of the tokenizers library: BPE over byte letters with a mark at word ends.

    Texts are composed (NFC) and lower-cased, white space separates words and is lost; the strings of added
    tokens stand for their ids wherever they occur.
    """

    def __init__(self, content: str):
        told = json.loads(content)
        model = told["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ", 1)): i for i, m in enumerate(model["merges"])}
        self.end = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        self.letters = byte_letters()
        self.bytes = {c: b for b, c in enumerate(self.letters)}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        found = self.old.get(word)
        if found is None:
            symbols = [self.letters[b] for b in word.encode("utf-8", "replace")]
            symbols[-1] += self.end
            found = [self.ids[s] for s in merge_order(symbols, self.ranks) if s in self.ids]
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[word] = found
        return found

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.parts.split(text) if self.parts else [text]:
            if part in self.added:
                out.append(self.added[part])
                continue
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for word in self.words.findall(part):
                found = self.young.get(word)
                out += self.word(word) if found is None else found
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens with spaces between, as the library gives them for a vocabulary without a decoder."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def text(self, ids: list[int]) -> str:
        """The words themselves: byte letters turned back, a space after each word."""
        out = bytearray()
        for i in ids:
            token = self.tokens[i]
            if token in self.added:
                out += token.encode() + b" "
                continue
            ends = bool(self.end) and token.endswith(self.end)
            out += bytes(self.bytes[c] for c in (token[: -len(self.end)] if ends else token)) + (b" " if ends else b"")
        return out.decode("utf-8", "replace").strip(" ")


_LOADED: dict[str, Vocabulary] = {}


def loaded(content: str) -> Vocabulary:
    """Built once per worker, the last one used."""
    if content not in _LOADED:
        _LOADED.clear()
        _LOADED[content] = Vocabulary(content)
    return _LOADED[content]


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of docs, by the vocabulary file at the given path.

    ids is an array of ints, decoded what the library makes of them. Null and empty texts have no ids and
    decode to the empty text. Texts are taken whole, whatever their length or the length of their words.
    Repeated rows stay. Other columns are not looked at. An empty table gives an empty table.
    The file is read by the driver and sent to the workers; its size is fixed (under 2 MB).
    """
    with open(vocabulary, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def rows(ids: list, found: list, decoded: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = loaded(content.value)
        for batch in batches:
            ids, found, decoded, held = [], [], [], 0
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = known.encode(text.as_py() or "")
                ids.append(id_)
                found.append(own)
                decoded.append(known.decode(own))
                held += 4 * len(own) + len(decoded[-1])
                if held > BATCH:
                    yield rows(ids, found, decoded)
                    ids, found, decoded, held = [], [], [], 0
            if ids:
                yield rows(ids, found, decoded)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded texts."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
