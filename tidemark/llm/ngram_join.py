"""Documents whose word shingles overlap: parity sketches cut into lanes, joined lane by lane, verified.

Two sets of sizes x and y with Jaccard similarity t differ in at most (x + y)(1 - t)/(1 + t) shingles.
Each shingle flips one place of a sketch: it is XORed into one of k lanes. A shingle that only one
set has touches one lane, so with k lanes and s differing shingles at least k - s lanes are equal. Lanes
are joined within a band of set sizes; a document also visits the band below if a partner can be there.

Lanes that hold few shingles (fewer than the band's least) say little and are many, so they are left out, as
long as the document has more equal lanes than such lanes in the worst case. A document that cannot
promise this is weak: its sparse lanes are joined as well, with those of other weak documents. A pair has
a promise from one side, or both sides are weak: no pair is lost.

Pairs that share a lane are never listed. Each lane links its documents to its smallest one, the links'
connected parts are the places where pairs can be, and each part is compared in blocks: parity sketches
first (their Hamming distance is at most the symmetric difference), then the shingle sets
themselves, skipping pairs that are already connected.

Shingles are held as 64-bit hashes and sets are named by a 64-bit digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import LAST_ID, dropped, mixed, saved, shingle_set
from tidemark.llm.components import components

WORDS, THRESHOLD = 5, (80, 100)
#: Shingles that one side of a comparison holds at most, unless a single document has more.
BLOCK = 1 << 20
SEEN = 1 << 20
LANE, WEAK, PART = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def linked_documents(docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text).

    Two documents link when their shingle sets have a Jaccard similarity of threshold[0] / threshold[1] or
    more; component_id is the smallest doc_id reachable by links. Texts are lower-cased (A-Z), words are
    what white space separates, a text of fewer than `words` words is one shingle.
    Null, empty and blank texts have no shingles, link with nothing and are their own component. A row
    without doc_id links like any other and has no say in component_id, which is null where no
    linked row has one. Repeated rows and ties stay, each with the same component. Other columns
    are not looked at. An empty table gives an empty table.
    """
    found, ids = _named(docs, words, threshold)
    alone = F.col("node").isNull()
    return found.join(ids, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("sets")).alias("distinct_sets"),
    )


def _named(docs: DataFrame, words: int, threshold: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Every row's set, and (node, root, component_id, sets) of every set; both stored.

    A row is known by its doc_id and a hash of its text, so neither rows without an id nor ids used twice are
    taken for one another.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _mark(F.col("text")).alias("mark")
    )
    found = saved(docs.mapInArrow(_sets(words, threshold), "doc_id long, mark long, n_shingles long, node long, v1 long, v2 long"), "sets")
    stars = saved(_stars(docs, words, threshold), "stars")
    parts = saved(components(stars), "parts")
    links = saved(_links(docs, found, parts, words, threshold), "links")
    classes = found.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    joined = components(links).select(F.col("vertex").alias("node"), F.col("root"))
    named = classes.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = saved(named, "classes")
    roots = saved(named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("sets")), "roots")
    ids = saved(named.join(roots, "root").select("node", "root", "component_id", "sets"), "names")
    for used in (stars, parts, links, named, roots):
        dropped(used)
    return found, ids


def _mark(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST_ID))


def one_of_each(docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The first row of docs of every component, with all its columns.

    First is the smallest doc_id (rows without one come last), among rows of one id the one whose text has the smallest
    hash, and of rows with the same id and text any one: a table that was loaded twice leaves one of each. Rows
    without words are in no component; they all stay.
    """
    found, ids = _named(docs, words, threshold)
    rows = found.join(ids.select("node", "root"), "node").select("root", _id(F.col("doc_id")).alias("id"), "mark")
    rows = saved(rows.groupBy("root", "id", "mark").agg(F.count("*").alias("n")), "component-rows")
    firsts = rows.groupBy("root").agg(F.min(F.struct("id", "mark")).alias("first"))
    gone = rows.join(firsts, "root").where(F.struct("id", "mark") != F.col("first")).select("id", "mark")
    # The whole row is one column here, so no name of its own can clash.
    given = docs.select(F.struct("*").alias("given"), _id(F.col("doc_id")).alias("id"), _mark(F.col("text")).alias("mark"))
    left = given.join(gone, ["id", "mark"], "left_anti")
    twice = rows.where("n > 1").select("id", "mark")
    if twice.isEmpty():
        return left.select("given.*")
    once = left.join(twice, ["id", "mark"], "left_anti").select("given")
    several = left.join(twice, ["id", "mark"], "left_semi").groupBy("id", "mark")
    return once.unionByName(several.agg(F.min_by("given", F.to_json("given")).alias("given")).select("given")).select("given.*")


# Bands and lanes


def _most_apart(x: int, y: int, threshold: tuple[int, int]) -> int:
    """Shingles in which linked sets of these sizes differ at most."""
    num, den = threshold
    return (x + y) * (den - num) // (den + num)


@cache
def _band(g: int, threshold: tuple[int, int]) -> tuple[int, int, int]:
    """(lanes, least shingles of a lane, most differing shingles) of the band of sizes 2**g to 2**(g+1) - 1."""
    num, den = threshold
    top = 2 ** (g + 1) - 1
    s = _most_apart(top, top * den // num, threshold)
    least = 2 if g >= 7 else 1
    if not s:
        return 0, least, 0

    def spare(k: int) -> float:
        mean = top / k
        low = k * exp(-mean) * (1 + mean * (least - 1))
        return (k - s - low) / sqrt(low + 1)

    tried = sorted({s + 1 + int(s * i / 20) + i % 20 for i in range(60)})
    return next((k for k in tried if spare(k) >= 2.5), max(tried, key=spare)), least, s


def _bands(n: int, threshold: tuple[int, int]) -> list[int]:
    """The band of a size, and the one below if a smaller partner can be there."""
    num, den = threshold
    g = n.bit_length() - 1
    return [g, g - 1] if g and (2**g - 1) * den // num >= n else [g]


def _node(h: np.ndarray) -> np.uint64:
    return mixed(np.array([h.sum(dtype=np.uint64) ^ np.uint64(len(h))], np.uint64))[0]


def _vertex(node: np.uint64, g: int) -> int:
    """Names a set within a band."""
    return int(mixed(np.array([node ^ (PART * np.uint64(g + 1))], np.uint64)).view(np.int64)[0])


def lane_keys(h: np.ndarray, g: int, threshold: tuple[int, int]) -> np.ndarray:
    """Keys of the lanes by which a set is joined in band g."""
    num, den = threshold
    k, least, most = _band(g, threshold)
    if not k:
        return np.empty(0, np.uint64)
    lane = mixed(h ^ LANE) % np.uint64(k)
    order = np.argsort(lane)
    at = lane[order]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    held = np.diff(np.r_[starts, len(at)])
    parity = np.bitwise_xor.reduceat(h[order], starts)
    name = at[starts] + np.uint64((g + 1) << 32)
    full = held >= least
    keys = mixed(parity[full] ^ mixed(name[full] * LANE))
    apart = min(most, _most_apart(len(h), len(h) * den // num, threshold))
    if k - apart > k - int(full.sum()):
        return keys
    sparse = np.zeros(k, np.uint64)
    sparse[at[starts].astype(np.int64)] = parity
    rest = np.ones(k, bool)
    rest[at[starts[full]].astype(np.int64)] = False
    lanes = np.flatnonzero(rest).astype(np.uint64)
    return np.r_[keys, mixed(sparse[rest] ^ mixed((lanes + np.uint64((g + 1) << 32)) * WEAK))]


# Passes over the texts


def _sets(words: int, threshold: tuple[int, int]):
    """Name, size and bands of every document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                sizes, nodes, first, second = [], [], [], []
                for text in batch.column(1):
                    h = shingle_set(text.as_py(), words)
                    node = _node(h) if len(h) else None
                    at = [_vertex(node, g) for g in _bands(len(h), threshold)] if len(h) else []
                    sizes.append(len(h))
                    nodes.append(None if node is None else int(node.view(np.int64)))
                    first.append(at[0] if at else None)
                    second.append(at[1] if len(at) > 1 else None)
                yield pa.record_batch(
                    [batch.column(0), batch.column(2), *(pa.array(x, pa.int64()) for x in (sizes, nodes, first, second))],
                    ["doc_id", "mark", "n_shingles", "node", "v1", "v2"],
                )

    return run


def _stars(docs: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """(a, b): for every lane that several sets share, each set with the smallest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task say the same
        with np.errstate(over="ignore"):
            for batch in batches:
                keys, names, held = [], [], 0
                for text in batch.column(0):
                    h = shingle_set(text.as_py(), words)
                    if not len(h) or (node := _node(h)) in seen:
                        continue
                    if len(seen) < SEEN:
                        seen.add(node)
                    for g in _bands(len(h), threshold):
                        own = lane_keys(h, g, threshold)
                        if len(own):
                            keys.append(own)
                            names.append(np.full(len(own), _vertex(node, g), np.int64))
                            held += len(own)
                    if held > 200_000:
                        yield _rows(keys, names)
                        keys, names, held = [], [], 0
                if held:
                    yield _rows(keys, names)

    def _rows(keys: list, names: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(names))], ["key", "b"])

    lanes = docs.select("text").mapInArrow(run, "key long, b long")
    return lanes.withColumn("a", F.min("b").over(Window.partitionBy("key"))).where("a < b").select("a", "b").distinct()


def _links(docs: DataFrame, found: DataFrame, parts: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """(a, b): sets of a part with the smallest one that verified links connect them with."""
    id_ = _id(F.col("doc_id"))
    reps = found.where("node is not null").groupBy("node").agg(
        F.min(id_).alias("id"), F.min_by("mark", id_).alias("mark"), F.first("n_shingles").alias("n"), F.first("v1").alias("v1"), F.first("v2").alias("v2")
    )
    placed = reps.select("id", "mark", "node", "n", F.explode(F.array("v1", "v2")).alias("vertex")).where("vertex is not null")
    placed = saved(placed.join(parts, "vertex").select("id", "mark", "node", "n", F.col("root").alias("part")), "placed")
    blocks = placed.groupBy("part").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    wanted = placed.join(blocks, "part").groupBy("node", "id", "mark").agg(
        F.collect_list("part").alias("parts"), F.collect_list("blocks").alias("blocks")
    )
    # By merge at every size: what is wanted grows with the copies in the input, so it is not a side to broadcast.
    texts = docs.select(_id(F.col("doc_id")).alias("id"), "mark", "text").join(wanted.hint("merge"), ["id", "mark"])
    sides = texts.select("text", "node", "parts", "blocks").mapInArrow(
        _blocks(words), "unit long, part long, own int, other int, node long, shingles binary"
    )
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return sides.repartition(tasks, "unit").sortWithinPartitions("unit", "part", "own", "other", "node").mapInArrow(_verify(threshold), "a long, b long")


def _blocks(words: int):
    """A set once for every pair of blocks of its part that its own block is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                rows, size = [], 0
                for text, node, parts, blocks in zip(*(batch.column(i) for i in range(4)), strict=True):
                    h, node = shingle_set(text.as_py(), words), node.as_py()
                    if not len(h) or int(_node(h).view(np.int64)) != node:
                        continue  # another text with the same id and hash
                    for part, n in zip(parts.as_py(), blocks.as_py(), strict=True):
                        own = int(np.uint64(node & (2**64 - 1)) % np.uint64(n))
                        for other in range(n):
                            lo, hi = min(own, other), max(own, other)
                            unit = int(mixed(np.array([np.uint64(part & (2**64 - 1)) + np.uint64(lo * 1000003 + hi)], np.uint64)).view(np.int64)[0])
                            rows.append((unit, part, lo, hi, node, h.tobytes()))
                            size += h.nbytes
                    if size > 1 << 24:
                        yield _sides(rows)
                        rows, size = [], 0
                if rows:
                    yield _sides(rows)

    def _sides(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["unit", "part", "own", "other", "node", "shingles"])

    return run


def _verify(threshold: tuple[int, int]):
    """Rows come sorted by pair of blocks; each pair of blocks is compared by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            for unit, part, lo, hi, node, h in zip(*(batch.column(i) for i in range(6)), strict=True):
                key = (unit.as_py(), part.as_py(), lo.as_py(), hi.as_py())
                if key != now:
                    yield from _edges(held)
                    now, held = key, {}
                held[node.as_py()] = np.frombuffer(h.as_py(), np.uint64)
        yield from _edges(held)

    def _edges(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(held) > 1 and (found := connecting_links(held, threshold)):
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    return run


def connecting_links(held: dict[int, np.ndarray], threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """(smallest, other) for every other one of the given sets that links connect."""
    num, den = threshold
    names = sorted(held, key=lambda x: (len(held[x]), x))
    sets = [held[x] for x in names]
    sizes = np.array([len(s) for s in sets], np.int64)
    bits = max(256, 1 << min(17, int(2 * sizes[-1] - 1).bit_length()))
    sketches = np.empty((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        sketches[i] = np.packbits((np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.uint64)
    top = list(range(len(sets)))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    step = max(1, (1 << 22) // sketches[0].nbytes)
    for i in range(len(sets) - 1):
        end = int(np.searchsorted(sizes, sizes[i] * den // num, "right"))
        for at in range(i + 1, end, step):
            to = min(end, at + step)
            apart = np.bitwise_count(sketches[at:to] ^ sketches[i]).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero(apart <= (sizes[at:to] + sizes[i]) * (den - num) // (den + num))
            for j in (at + near[np.argsort(apart[near], kind="stable")]).tolist():
                if find(i) == find(j):
                    continue
                a, b = sets[i], sets[j]
                both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                if den * both >= num * (len(a) + len(b) - both):
                    top[find(j)] = find(i)
    roots: dict[int, int] = {}
    for i in range(len(names)):
        roots[find(i)] = min(roots.get(find(i), names[i]), names[i])
    return [(roots[find(i)], n) for i, n in enumerate(names) if n != roots[find(i)]]
