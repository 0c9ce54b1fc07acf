"""Language of a text by compression: the dictionary that makes it smallest names its language.

A language's dictionary is raw content: pieces of its own texts, taken from a bounded sample. A text is
compressed with each language's dictionary, and the language of the smallest result is predicted. The margin is
what the second smallest is larger; a prediction with a narrow margin is marked as not accepted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

UNKNOWN = "und"
#: Bounds of the sample: documents of a language, code points of words taken of each, bytes of a dictionary.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY = 400, 400, 1 << 16
#: Bytes of all dictionaries together, at least LEAST_DICTIONARY of each: the more languages, the smaller each one's.
ALL_DICTIONARIES, LEAST_DICTIONARY = 1 << 22, 512
LEVEL, NARROW = 7, 0.01
#: Bytes compressed at once, so that a long text has the dictionary near everywhere.
PIECE = 1 << 9
#: All that is no letter.
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The text's words in lower case: signs and digits are the same in every language."""
    return OTHER.sub(" ", text.lower())


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """Raw-content dictionaries by language from labelled rows (doc_id, text, lang), languages with most rows first.

    Of each language the SAMPLE_DOCS rows with the least hashes of doc_id are taken, of each row the first SAMPLE_CHARS
    code points of its words, wherever in the text they begin. Rows without text, letters or language are not learned
    from. Where there are more languages than full dictionaries fit, all get smaller ones, from fewer rows.
    What comes to the driver is a count per language, and code points in proportion to the dictionaries.
    """
    able = labelled.select(
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64(F.col("doc_id").cast("string")).alias("mark"),
        F.col("text").cast("string").alias("text"),
    ).where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in able.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    size = min(DICTIONARY, max(LEAST_DICTIONARY, ALL_DICTIONARIES // len(counts)))
    docs = max(4, SAMPLE_DOCS * size // DICTIONARY)
    # Hashes are uniform: the least of n are looked for among the lowest 4 * docs / n of all, so what
    # meets in one task does not grow with the number of tasks.
    lowest = {x: -(2**63) + min(2**64 - 1, max(64, 4 * docs) * 2**64 // n) for x, n in counts.items()}
    upto = F.create_map(*[F.lit(v) for pair in lowest.items() for v in pair])
    said = F.substring(F.trim(F.regexp_replace("text", r"[^\p{L}]+", " ")), 1, SAMPLE_CHARS)
    low = able.where(F.col("mark") <= F.try_element_at(upto, F.col("lang"))).withColumn("text", said)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark", "text"))
    taken = low.withColumn("rank", rank).where(F.col("rank") <= docs).select("lang", "rank", "text").collect()
    held: dict[str, list[str]] = {}
    for row in sorted(taken, key=lambda r: (r.lang, -r.rank)):
        held.setdefault(row.lang, []).append(letters(row.text))
    order = sorted(held, key=lambda x: (-counts[x], x))
    return {lang: " ".join(held[lang]).encode("utf-8", "replace")[-size:] for lang in order}


class Sizes:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, known: dict[str, bytes]):
        self.langs = list(known)
        self.encoders = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=self._prepared(known[x]), write_checksum=False, write_content_size=False, write_dict_id=False)
            for x in self.langs
        ]

    @staticmethod
    def _prepared(content: bytes) -> zstandard.ZstdCompressionDict:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        return held

    def of(self, text: str) -> list[int]:
        data = letters(text).encode("utf-8", "replace")
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(e.compress(p)) for p in pieces) for e in self.encoders]

    def predicted(self, text: str | None) -> tuple[str, float]:
        """(language, margin): the margin is 1 - smallest / second smallest, 1 if there is only one language."""
        if not text or not self.langs or not any(map(str.isalpha, letters(text))):
            return UNKNOWN, 0.0
        sizes = self.of(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0
        return self.langs[order[0]], 1 - sizes[order[0]] / sizes[order[1]]


def identified(docs: DataFrame, known: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every row of docs, by its text alone.

    score is the margin, from 0 to 1. accepted is false where the margin is narrower than `narrow` (the nearest
    language is still named). Null texts and texts without a letter are `und`, with score 0 and not
    accepted, as is everything if there are no dictionaries. Ties go to the first of the dictionaries. Texts are
    taken whole. Repeated rows stay. Other columns are not looked at. An empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(known)
        for batch in batches:
            found = [sizes.predicted(t.as_py()) for t in batch.column(1)]
            langs, scores = zip(*found, strict=True) if found else ((), ())
            yield pa.record_batch(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array([n != UNKNOWN and s >= narrow for n, s in found], pa.bool_())],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def language_predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted): learned from the rows whose remainder is not 2.

    Rows without doc_id are neither held out nor learned from.
    """
    known = dictionaries(docs.where(remainder(F.col("doc_id")) != 2))
    found = identified(docs, known)
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")
