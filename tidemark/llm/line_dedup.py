"""Repeated lines, paragraphs and passages: units of text hashed, grouped globally, the earliest occurrence kept.

Units are normalised (lower case, blanks and line ends alike) and hashed to 64 bits:

* every line and every paragraph (lines between lines without words) of at least `least` words, whole;
* every two neighbouring pieces of a text. A text is cut between two words where the hash of the two is the
  smallest among those of RADIUS places before and after, whatever the line ends, so a passage is cut the same way
  wherever it stands and however it is wrapped;
* any WINDOW words in which those cuts lie so badly that the pieces inside have fewer than `least` words.

The earliest document that has a unit keeps it. In the others, and after its first place within a document, the unit is
a repeat. Repeated lines, paragraphs and windows are cut out; of repeated pairs of pieces, those runs that make
`least` words together: shorter ones are common phrases and stay. So every line and paragraph from `least` words on
goes from all documents but the first, and of any other WINDOW repeated words at least `least`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import LAST_ID, PLACE, hashes_of, mixed, slices, text_bytes, word_places

LEAST_WORDS = 25
WINDOW = 2 * LEAST_WORDS
RADIUS = 2
#: Bytes of text that are worked on at once (one text at least), windows that are hashed at once.
SLICE, AT_ONCE = 4_000_000, 20_000
#: Bytes that separate words.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
FAR = np.uint64(2**64 - 1)
SPANS = "removed_spans array<struct<start: long, end: long>>"


def without_repeats(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """docs with repeats cut out of text (and n_chars, if there, counted anew) and a column removed_spans.

    removed_spans holds the [start, end) code points of the original text that were cut, in order; an
    existing column of that name is replaced. The earliest document is the one with the smallest doc_id;
    rows without doc_id come last, and rows with the same doc_id rank alike: neither loses text to the
    other. Null and empty texts stay as they are, a text of nothing but repeats becomes empty.
    Other columns pass unchanged, whatever their names. An empty table gives an empty table.
    """
    docs = docs.drop("removed_spans")
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id")
    # An id may stand in many rows (null in many, too): each text has its own repeats.
    tie = F.xxhash64(F.col("text").cast("string")).alias("tie")
    texts = docs.select(rank, tie, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    units = texts.mapInArrow(_units(least), "unit long, id long, tie long")
    firsts = units.groupBy("unit").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    repeats = units.join(firsts.select("unit", "first"), "unit").where("id > first")
    repeats = repeats.groupBy("id", "tie").agg(F.collect_set("unit").alias("repeats"))
    schema = T.StructType([*docs.schema, *T._parse_datatype_string(SPANS)])
    # The whole row is one column here, so no name of its own can clash.
    rows = docs.select(F.struct("*").alias("row"), rank, tie).join(repeats, ["id", "tie"], "left").select("row", "repeats")
    return rows.mapInArrow(_cut(docs.schema, least), schema)


class Units:
    """Units of several texts: digests, and the words from first to last that each covers."""

    def __init__(self, texts: pa.Array, least: int = LEAST_WORDS):
        data, offsets = text_bytes(pc.utf8_lower(texts))
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        starts, lengths = word_places(~BLANK[data], offsets)
        self.doc = np.searchsorted(offsets, starts, "right") - 1
        self.opening = np.searchsorted(self.doc, np.arange(len(texts)))
        self.least, self.n = least, len(starts)
        h = hashes_of(data, starts, lengths)
        lines = np.searchsorted(np.flatnonzero(data == 0x0A), starts)
        self._pairs(h)
        chosen = [self._pair_units, *self._whole(h, lines), self._windows(h)]
        self.digests, self.first, self.last = (np.concatenate([c[i] for c in chosen]) for i in range(3))
        self.of = self.doc[self.first]
        self.pairs = len(self._pair_units[0])
        self.windows = len(chosen[-1][0])

    def _pairs(self, h: np.ndarray) -> None:
        """Cuts, and every two pieces between three of them."""
        n, same = self.n, self.doc[1:] == self.doc[:-1]
        joint = np.where(same, np.minimum(mixed(h[:-1] * PLACE + h[1:]), FAR - np.uint64(1)), FAR)
        padded = np.r_[np.full(RADIUS, FAR), joint, np.full(RADIUS, FAR)]
        least = joint.copy()
        for i in range(2 * RADIUS + 1):
            near = padded[i : i + len(joint)]
            # Places of another text do not count.
            shift = i - RADIUS
            here = np.arange(len(joint)) + shift
            own = (here >= 0) & (here < len(joint))
            own[own] = self.doc[:-1][own] == self.doc[np.clip(here, 0, max(n - 2, 0))][own]
            least = np.where(own, np.minimum(least, near), least)
        self.cut = np.r_[~same | (joint == least), True][:n]
        first = np.flatnonzero(np.r_[True, self.cut[:-1]][:n])
        digests = _digests(h, first)
        last = np.r_[first[1:], n] - 1
        self.pieces = len(first)
        two = np.flatnonzero(self.doc[first[1:]] == self.doc[first[:-1]])
        self.pair_piece = two
        self._pair_units = (mixed(mixed(digests[two]) * PLACE + digests[two + 1]), first[two], last[two + 1])

    def _whole(self, h: np.ndarray, lines: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Lines and paragraphs of enough words; a paragraph of one line is that line."""
        other = self.doc[1:] != self.doc[:-1]
        found = []
        for step in (1, 2):
            opens = np.r_[True, other | (lines[1:] - lines[:-1] >= step)][: self.n]
            first = np.flatnonzero(opens)
            last = np.r_[first[1:], self.n][: len(first)] - 1
            long = last - first + 1 >= self.least
            if step == 2:
                long &= lines[first] < lines[last]
            found.append((_digests(h, first)[long], first[long], last[long]))
        return found

    def _windows(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows of one text in which pieces between cuts that any neighbours leave alone have too few words."""
        at = np.arange(max(self.n - WINDOW + 1, 0))
        at = at[self.doc[at] == self.doc[at + WINDOW - 1]]
        places, before = np.flatnonzero(self.cut), np.r_[0, np.cumsum(self.cut)]
        low, high = before[at + RADIUS], before[at + WINDOW - 1 - RADIUS] - 1
        words = places[np.maximum(high, 0)] - places[np.minimum(low, len(places) - 1)] if len(at) else at
        at = at[(high - low < 2) | (words < self.least)]
        digests = [np.empty(0, np.uint64)]
        for i in range(0, len(at), AT_ONCE):
            held = at[i : i + AT_ONCE, None] + np.arange(WINDOW)
            digests.append(_digests(h[held.ravel()], np.arange(0, held.size, WINDOW)))
        return np.concatenate(digests), at, at + WINDOW - 1

    def own(self) -> np.ndarray:
        """Digests that also tell the texts apart."""
        return _in_text(self.digests, self.of)

    def looked_up(self) -> tuple[np.ndarray, np.ndarray]:
        """What other documents may share: digests and texts, each digest of a text once."""
        once = np.unique(self.own(), return_index=True)[1]
        return self.digests[once].view(np.int64), self.of[once]

    def repeated(self, digests: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Units that earlier documents have (their digests and texts are given), or that stand earlier in the same text."""
        own = self.own()
        known, which = np.unique(own, return_inverse=True)
        earliest = np.full(len(known), self.n)
        np.minimum.at(earliest, which, self.first)
        # Windows may overlap: only one that ends before can be what another repeats.
        apart = np.ones(len(own), np.int64)
        apart[len(own) - self.windows :] = WINDOW
        again = self.first - earliest[which] >= apart
        return again | np.isin(own, _in_text(digests.view(np.uint64), texts))

    def ranges(self, repeated: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, first word, last word) of what is to be cut, in order, joined where they touch; words counted by text."""
        chain = np.zeros(self.pieces + 1, bool)
        chain[self.pair_piece[repeated[: self.pairs]]] = True
        edges = np.flatnonzero(np.diff(np.r_[False, chain].astype(np.int8)))
        pair = np.zeros(self.pieces + 1, np.int64)
        pair[self.pair_piece] = np.arange(self.pairs)
        a, b = self.first[pair[edges[::2]]], self.last[pair[edges[1::2] - 1]]
        long = b - a + 1 >= self.least
        rest = np.flatnonzero(repeated[self.pairs :]) + self.pairs
        a, b = np.r_[a[long], self.first[rest]], np.r_[b[long], self.last[rest]]
        out: list[tuple[int, int, int]] = []
        for i in np.argsort(a, kind="stable"):
            doc = int(self.doc[a[i]])
            low, high = int(a[i] - self.opening[doc]), int(b[i] - self.opening[doc])
            if out and out[-1][0] == doc and low <= out[-1][2] + 1:
                out[-1] = (doc, out[-1][1], max(out[-1][2], high))
            else:
                out.append((doc, low, high))
        return out


def _digests(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Digests of the stretches of words that begin at these places and end before the next."""
    if not len(first):
        return np.empty(0, np.uint64)
    length = np.diff(np.r_[first, len(h)])
    place = np.arange(len(h)) - np.repeat(first, length)
    return mixed(np.add.reduceat(mixed(h + place.astype(np.uint64) * PLACE), first) + length.astype(np.uint64))


def _in_text(digests: np.ndarray, texts: np.ndarray) -> np.ndarray:
    return mixed(digests + (texts + 1).astype(np.uint64) * PLACE)


def _units(least: int):
    """What is looked up of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for at, to in slices(text_bytes(batch.column(2))[1], SLICE):
                digests, of = Units(batch.column(2).slice(at, to - at), least).looked_up()
                rows = pa.array(of + at)
                yield pa.record_batch([pa.array(digests), batch.column(0).take(rows), batch.column(1).take(rows)], ["unit", "id", "tie"])

    return run


def cut_texts(texts: pa.Array, digests: np.ndarray, of: np.ndarray, least: int) -> dict[int, tuple[str, list[dict]]]:
    """The texts that lose something: their number, what stays, and the code points that go."""
    units = Units(texts, least)
    found: dict[int, list[tuple[int, int]]] = {}
    for doc, a, b in units.ranges(units.repeated(digests, of)):
        found.setdefault(doc, []).append((a, b))
    return {doc: _without(texts[doc].as_py(), ranges) for doc, ranges in found.items()}


def _without(text: str, ranges: list[tuple[int, int]]) -> tuple[str, list[dict]]:
    """The text without these words and the blanks that would be left double."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    starts, lengths = word_places(~BLANK[data], np.array([0, len(data)]))
    lines = np.searchsorted(np.flatnonzero(data == 0x0A), starts)
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    keep, spans = np.ones(len(data), bool), []
    for a, b in ranges:
        if b + 1 == len(starts):
            end = len(data)
        elif lines[b + 1] == lines[b] or a == 0 or lines[a - 1] != lines[a]:
            end = starts[b + 1]
        else:
            end = starts[b] + lengths[b]
        keep[starts[a] : end] = False
        spans.append({"start": int(points[starts[a]]), "end": int(points[end])})
    return data[keep].tobytes().decode(), spans


def _cut(schema: T.StructType, least: int):
    names = schema.names
    text_at, count_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns, repeats = batch.column(0).flatten(), batch.column(1)
            texts = columns[text_at].cast(pa.string()).fill_null("")
            each = repeats.value_lengths().fill_null(0).to_numpy()
            digests, of = repeats.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(each)), each)
            cut: dict[int, tuple[str, list[dict]]] = {}
            for at, to in slices(text_bytes(texts)[1], SLICE):
                mine = slice(*np.searchsorted(of, [at, to]))
                found = cut_texts(texts.slice(at, to - at), digests[mine], of[mine] - at, least)
                cut |= {doc + at: x for doc, x in found.items()}
            spans = [cut[i][1] if i in cut else [] for i in range(batch.num_rows)]
            if cut:
                mask, order = pa.array([i in cut for i in range(batch.num_rows)]), sorted(cut)
                columns[text_at] = pc.replace_with_mask(columns[text_at], mask, pa.array([cut[i][0] for i in order], columns[text_at].type))
                if count_at is not None:
                    lengths = pa.array([len(cut[i][0]) for i in order], columns[count_at].type)
                    columns[count_at] = pc.replace_with_mask(columns[count_at], mask, lengths)
            yield pa.record_batch([*columns, pa.array(spans, spans_type)], [*names, "removed_spans"])

    return run
