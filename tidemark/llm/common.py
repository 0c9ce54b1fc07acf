"""What several operators of this folder share: inputs, stored intermediate tables, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.shared import written_once as saved

SPACE = r"[\x20\x09-\x0D]+"
LAST_ID = 2**63 - 1

#: An odd multiplier that tells places apart; bytes from which a word is hashed on its own.
PLACE, LONG_WORD = np.uint64(0x9E3779B97F4A7C15), 256

__all__ = [
    "LAST_ID", "PLACE", "SPACE", "bind", "documents", "dropped", "eight_bytes", "hashes_of", "mixed", "saved", "shingle_set", "slices",
    "text_bytes", "window_hashes", "word_hashes", "word_places", "words",
]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def dropped(df: DataFrame) -> None:
    """Deletes the files of a frame made by saved() before the session ends: no later step reads them."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """Words of a text as an array, empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def bind(value: Column, use) -> Column:
    """use(value) with the value computed once: inside a lambda Spark would compute it per element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every window of `width` words."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(h) - width + 1, np.uint64)
        for i in range(width):
            total = total * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i]
        return mixed(total)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; A-Z are lower-cased, few words are one shingle."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(found), min(width, len(found))))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and the offsets at which its texts begin and end, without a copy."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """[from, to) rows of whole texts of `size` bytes at most, one text at least."""
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to
        at = to


def word_places(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of every word; inside says which bytes belong to words, texts go from offset to offset."""
    opens, ends = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(inside))]
    opens[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(ends) + 1 - starts


def eight_bytes(data: np.ndarray):
    """keys(starts, left): eight bytes from each place as one number that sorts like them, zeros from the left-th on."""
    padded = np.lib.stride_tricks.sliding_window_view(np.r_[data, np.zeros(8, np.uint8)], 8)

    def keys(starts: np.ndarray, left: np.ndarray) -> np.ndarray:
        some = left > 0
        found = padded[np.where(some, starts, 0)].view(">u8").ravel().astype(np.uint64)
        drop = (8 * (8 - np.clip(left, 1, 8))).astype(np.uint64)
        return np.where(some, found >> drop << drop, np.uint64(0))

    return keys


def hashes_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of every word at these places, of all words eight bytes at a time."""
    keys = eight_bytes(data)
    h, live, depth = lengths.astype(np.uint64), np.flatnonzero(lengths < LONG_WORD), 0
    while len(live):
        h[live] = mixed(h[live] * PLACE + keys(starts[live] + depth, lengths[live] - depth))
        depth += 8
        live = live[lengths[live] > depth]
    for i in np.flatnonzero(lengths >= LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes())
    return h
