"""Source divergence audit: how far the sources of a language are from each other and from the language.

Terms are counted by a pointer sort. Each task takes slices of its texts, sets a pointer at every word start in
the Arrow buffer, and sorts the pointers by the bytes they point at: a multikey quicksort whose characters are
slices of eight bytes, so a run of equal slices is only looked at further while it holds more than one pointer and a
word that goes on. Equal runs are the terms of the slice: the documents in a run are its document frequency,
their sources its source counts. Spark adds the counts of all slices up.

Every group (a source of a language) and every language then gives each kept term a smoothed share in
billionths, p = 1 + floor(10^9 * (count + 2) / (N + 2 V)), and two shares differ by floor((p - q)^2 / (p + q)). All of
it is integer arithmetic, so the result does not depend on how rows were dealt.

Two sources differ in every kept term, also in those that neither has. Kept terms are therefore dealt to blocks by
their hash, and a block holds its terms by the sources of the language as a matrix; the sums of the blocks are added up.
With more than TILE sources a block is cut into tiles of sources as well, so no task ever holds all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import eight_bytes, saved, slices, text_bytes, word_places

LEAST_DOCUMENTS = 10
TOP = 10
SCALE = 10**9
#: Bytes of text that are sorted at once (one document at least), kept terms in a block, sources in a tile.
SLICE, BLOCK, TILE = 8_000_000, 4096, 256
#: Entries of a matrix that are worked on at once.
ENTRIES = 2_000_000

#: What a byte of a term counts as: A-Z as a-z, bytes of other letters as they are, all else as 0.
TERM = np.zeros(256, np.uint8)
TERM[0x61:0x7B] = TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
TERM[0x80:] = np.arange(0x80, 0x100)

COUNTS = "lang string, source string, term string, n long, docs long"


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: for every group all other sources of its language by their
    difference (part `pair`), and the `top` terms it has more of than the language (part `term`).

    Terms are runs of letters (ASCII letters, lower-cased, and everything beyond ASCII); those in at least
    `least` documents of a language are kept. Null text, lang and source count as empty strings, which are
    groups like others. A group without kept terms has pairs but no terms; where a language keeps no term all
    pairs are 0. Repeated rows count as often as they stand there, whatever their ids. Equal values are
    ranked by the UTF-8 bytes of the item. An empty table gives no rows. Other columns do not matter.
    """
    counts = saved(term_counts(docs), "term-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least)
    kept = saved(counts.join(terms.drop("docs"), ["lang", "term"]), "kept-terms")
    groups = saved(_groups(docs, kept), "groups")
    shared = kept.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        _share(F.col("n"), F.col("total")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total")).alias("q"),
        "blocks",
        "tiles",
    )
    found = _ranked(_pairs(shared, groups), "pair").unionByName(_ranked(_terms(shared), "term").where(F.col("rank") <= top))
    return found.select("lang", "source", "part", "item", "value", "rank")


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: how often each group has each term, and in how many of its documents."""
    given = docs.select(*[_known(c).alias(c) for c in ("text", "lang", "source")])
    rows = given.mapInArrow(_counted, COUNTS)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _known(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group with the sums that its shares and those of its language need: one row per (lang, source)."""
    every = docs.select(_known("lang").alias("lang"), _known("source").alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang")
    langs = langs.agg(F.sum("n").alias("lang_n"), F.count("*").alias("v"))
    sources = every.groupBy("lang").agg(F.count("*").alias("sources"))
    n, lang_n, v = (F.coalesce(F.col(c), F.lit(0)) for c in ("n", "lang_n", "v"))
    joined = every.join(own, ["lang", "source"], "left").join(sources, "lang").join(langs, "lang", "left")
    return joined.select(
        "lang",
        "source",
        (n + 2 * v).alias("total"),
        (lang_n + 2 * v).alias("lang_total"),
        v.alias("v"),
        (F.lit(1) + F.expr(f"coalesce(v, 0) div {BLOCK}")).cast("int").alias("blocks"),
        (F.lit(1) + F.expr(f"(sources - 1) div {TILE}")).cast("int").alias("tiles"),
    )


def _share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * (count + 2) / total), exact also where the product does not fit a long; 1 if total is 0."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.when(total > 0, F.lit(1) + F.call_function("div", wide, F.nullif(total, F.lit(0)).cast("decimal(20,0)"))).otherwise(1)


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _terms(shared: DataFrame) -> DataFrame:
    p, q = F.col("p"), F.col("q")
    return shared.where(p > q).select("lang", "source", F.col("term").alias("item"), _difference(p, q).alias("value"))


def _pairs(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """Differences of all two sources of a language, added up over blocks of kept terms."""
    # Each block knows all sources of its tiles, with the share of a term that they do not have.
    none = groups.withColumn("p", _share(F.lit(0).cast("long"), F.col("total")))
    none = none.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("term", F.lit(None).cast("string"))
    # One block answers for the terms that no source of its tiles has: it knows how many there are in all.
    none = none.withColumn("v", F.when(F.col("block") == 0, F.col("v")).otherwise(0))
    rows = shared.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    columns = ["lang", "block", "term", "source", "p", "tiles", "v"]
    rows = rows.withColumn("v", F.lit(0).cast("long")).select(columns).unionByName(none.select(columns))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select(
        "lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "source", "term", "p", "v"
    )
    sums = rows.groupBy("lang", "block", "low", "high").applyInArrow(_block_sums, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("part", F.lit(part)).withColumn("rank", F.row_number().over(order))


def equal_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers in the order of what they point at, and where in this order runs of equal words open."""
    bytes_at = eight_bytes(data)

    def characters(pointers: np.ndarray, depth: int) -> np.ndarray:
        return bytes_at(starts[pointers] + depth, lengths[pointers] - depth)

    keys = characters(np.arange(len(starts)), 0)
    order = np.argsort(keys)
    opens = np.r_[True, np.diff(keys[order]) != 0][: len(starts)]
    places, depth = _unsettled(np.arange(len(starts)), opens, lengths[order] > 8), 8
    while len(places):
        pointers, run = order[places], np.cumsum(opens[places])
        keys = characters(pointers, depth)
        by = np.lexsort((keys, run))
        order[places], keys = pointers[by], keys[by]
        opens[places[1:]] |= (run[1:] == run[:-1]) & (keys[1:] != keys[:-1])
        depth += 8
        places = _unsettled(places, opens[places], lengths[order[places]] > depth)
    return order, opens


def _unsettled(places: np.ndarray, opens: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
    """Places in runs of more than one pointer in which a word goes on."""
    first = np.flatnonzero(opens)
    if not len(first):
        return places[:0]
    size = np.diff(np.r_[first, len(places)])
    return places[np.repeat((size > 1) & np.logical_or.reduceat(goes_on, first), size)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the slices of each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(0))
        groups = _numbers(batch.column(1), batch.column(2))
        for at, to in slices(offsets, SLICE):
            texts = TERM[data[offsets[at] : offsets[to]]]
            yield from _slice_counts(texts, offsets[at : to + 1] - offsets[at], groups[at:to], batch.slice(at, to - at))


def _numbers(lang: pa.Array, source: pa.Array) -> np.ndarray:
    """A number for each (lang, source) of the rows."""
    lang, source = (c.dictionary_encode().indices.to_numpy().astype(np.int64) for c in (lang, source))
    return lang * (source.max() + 1) + source


def _slice_counts(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    starts, lengths = word_places(data != 0, offsets)
    if not len(starts):
        return
    order, opens = equal_runs(data, starts, lengths)
    run = np.empty(len(starts), np.int64)
    run[order] = np.cumsum(opens) - 1
    # Documents by group, so that within a run those of one group are neighbours.
    by_group = np.argsort(groups, kind="stable")
    place = np.empty(len(groups), np.int64)
    place[by_group] = np.arange(len(groups))
    document = np.searchsorted(offsets, starts, "right") - 1
    seen = np.sort(run * len(groups) + place[document])
    first = np.flatnonzero(np.r_[True, seen[1:] != seen[:-1]])
    times = np.diff(np.r_[first, len(seen)])
    term, doc = np.divmod(seen[first], len(groups))
    group = groups[by_group][doc]
    parts = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (group[1:] != group[:-1])])
    heads = order[opens]
    words = _strings(data, starts[heads], lengths[heads])
    held = pa.array(by_group[doc[parts]])
    yield pa.record_batch(
        [
            rows.column(1).take(held),
            rows.column(2).take(held),
            words.take(pa.array(term[parts])),
            pa.array(np.add.reduceat(times, parts)),
            pa.array(np.diff(np.r_[parts, len(term)])),
        ],
        ["lang", "source", "term", "n", "docs"],
    )


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(lengths)]
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at])]
    return pa.Array.from_buffers(pa.string(), len(starts), buffers)


def _block_sums(key: tuple, rows: pa.Table) -> pa.Table:
    """Differences of the sources of one block, summed over its terms, less what none of them has: block 0 has all of that."""
    lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
    marks = rows.filter(rows.column("term").is_null())
    names = np.array(marks.column("source").to_pylist(), object)
    order = np.argsort(names)
    names, none, tile = names[order], marks.column("p").to_numpy()[order], marks.column("tile").to_numpy()[order]
    has = rows.filter(rows.column("term").is_valid())
    terms = has.column("term").combine_chunks().dictionary_encode()
    number = {name: i for i, name in enumerate(names.tolist())}
    source = np.fromiter((number[s] for s in has.column("source").to_pylist()), np.int64, has.num_rows)
    shares = np.broadcast_to(none, (len(terms.dictionary), len(names))).copy()
    shares[terms.indices.to_numpy(), source] = has.column("p").to_numpy()
    missing = marks.column("v").to_numpy().max() - len(shares)
    left, right, values = [], [], []
    for a in range(len(names)):
        # In a tile of its own each pair stands once; between two tiles those of the first meet those of the second.
        others = np.arange(a + 1, len(names)) if low == high else np.flatnonzero(tile == high) if tile[a] == low else np.empty(0, np.int64)
        if len(others):
            left += [names[a]] * len(others)
            right += names[others].tolist()
            values.append(_summed(shares, a, others) + missing * ((none[a] - none[others]) ** 2 // (none[a] + none[others])))
    pair = [(x, y) if x < y else (y, x) for x, y in zip(left, right, strict=True)]
    columns = [[lang] * len(pair), [x for x, _ in pair], [y for _, y in pair], np.concatenate(values) if values else []]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "item", "value"])


def _summed(shares: np.ndarray, a: int, others: np.ndarray) -> np.ndarray:
    total, step = np.zeros(len(others), np.int64), max(1, ENTRIES // len(others))
    for at in range(0, len(shares), step):
        p, q = shares[at : at + step, a : a + 1], shares[at : at + step, others]
        total += ((p - q) ** 2 // (p + q)).sum(0)
    return total
