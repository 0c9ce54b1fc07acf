"""Fingerprints that keep every shingle hash below a fixed fraction of all hashes.

A text's sketch is the set of its 5-word shingles' hashes that fall below 1/FRACTION of the hash space; its size
follows the text's. The same shingle is kept everywhere or nowhere, so the sketch of a union is the union of
the sketches, and the share of one sketch found in another estimates containment, however
unequal the texts are. A text none of whose shingles falls below keeps its smallest hash, so that only
texts without words have an empty sketch; merging drops such a hash as soon as a regular one is there.
Estimates therefore hold for texts of some 40 shingles and more. Of a text of k shingles (7/8)^k have such a stand-in
alone (26 % for 10, 12 % for 16, 0.5 % for 40), and their containment in a longer text that holds them comes out as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import bind, saved, words

WORDS, FRACTION = 5, 8
#: Hashes are signed; the lowest 1/FRACTION of them lie below this.
CEILING = -(2**63) + 2**64 // FRACTION


def fingerprint(text: Column, width: int = WORDS, ceiling: int = CEILING) -> Column:
    """The sketch of a text: sorted distinct hashes. Null counts as empty, few words are one shingle."""

    def hashes(w: Column) -> Column:
        windows = F.transform(F.slice(w, F.lit(1), F.size(w) - (width - 1)), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, width)]))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(F.size(w) < width, F.array(F.xxhash64(w))).otherwise(windows)

    return bind(bind(words(text), hashes), lambda h: kept(h, ceiling))


def kept(h: Column, ceiling: int = CEILING) -> Column:
    """The sketch of a set of hashes, given in any order and with repeats."""
    low = F.array_sort(F.array_distinct(F.filter(h, lambda x: x < ceiling)))
    least = F.filter(F.array(F.array_min(h)), lambda x: x.isNotNull())
    return bind(low, lambda x: F.when(F.size(x) > 0, x).otherwise(least))


def merged(a: Column, b: Column, ceiling: int = CEILING) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    return kept(F.concat(a, b), ceiling)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; two empty sketches are alike, an empty and another one are not."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; nothing is contained in anything."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ",")


def next_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id): the next smaller doc_id of every distinct one, the largest after the smallest.

    Ids are dealt out by range and numbered within each part; only a part's ends meet in one place.
    """
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    dealt = saved(dealt.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    ends = dealt.groupBy("part").agg(F.max("doc_id").alias("top"), F.min("doc_id").alias("bottom"))
    below = Window.orderBy(F.desc("bottom"))
    whole = Window.orderBy(F.desc("bottom")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lead("top").over(below), F.max("top").over(whole)).alias("after"))
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id")))
    return dealt.withColumn("inside", inside).join(ends, "part").select("doc_id", F.coalesce("inside", "after").alias("next_id"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's sketch, its edited text's, and how alike it is to that and to the next document's.

    Columns: doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next. The edited text is
    the text with its last floor(n_chars / 3) code points replaced by the first as many, or all, of the next
    document in descending doc_id; after the last comes the first, and a single document is its own next one.
    Null texts count as empty. Where a doc_id repeats, its least text stands for it as a next document, and
    every row stays. Rows without doc_id are nobody's next document and have none: nothing replaces
    what is cut, and near_next is null. Other columns are not looked at. An empty table gives an
    empty table.
    """
    # A bare column if the type allows it: Spark keeps an alias for only one of the two readers of `named`, and their
    # shuffles of all texts would then not be one and the same.
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    docs = docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = docs.where("doc_id is not null")
    after = saved(next_ids(named), "next")
    # What a document has to lend at most: as many code points as a third of the longest text before it.
    lent = named.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 3)).cast("int").alias("n"))
    lent = saved(after.join(lent, "doc_id").select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("to"), "n"), "lent")
    # The first of each id by lag, not by row_number() = 1: a limit planned before the shuffle would make it another
    # shuffle than the one below, and the texts would be written twice.
    lesser = F.lag(F.lit(1)).over(Window.partitionBy("doc_id").orderBy("text"))
    lenders = named.withColumn("lesser", lesser).where("lesser is null").drop("lesser").join(lent, "doc_id")
    loans = lenders.select("to", F.substring("text", F.lit(1), F.col("n")).alias("start"), fingerprint(F.col("text")).alias("next_sketch"))
    met = named.join(loans, named["doc_id"] == loans["to"]).select("doc_id", "text", "start", "next_sketch")
    alone = docs.where("doc_id is null").select("*", F.lit("").alias("start"), F.lit(None).cast("array<bigint>").alias("next_sketch"))
    met = met.unionByName(alone)
    third = F.floor(F.length("text") / 3).cast("int")
    cut = F.substring("text", F.lit(1), F.length("text") - third)
    edited = F.concat(cut, F.substring("start", F.lit(1), third))
    told = met.select("doc_id", "text", edited.alias("edited"), "next_sketch")
    told = told.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("sketch"),
        fingerprint(F.col("edited")).alias("edited_sketch"),
        "next_sketch",
    )
    return told.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "sketch",
        "edited_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        F.when(F.col("next_sketch").isNotNull(), likeness(F.col("sketch"), F.col("next_sketch"))).alias("near_next"),
    )
