"""A mix of sources by target weights: a low-discrepancy schedule of equal blocks of words.

Slot i of the schedule has the point i * 0.618... mod 1 (as whole numbers of 2**-32); the source whose part of
the cumulative targets holds the point gets the slot. The r-th slot of a source takes the r-th block of
BLOCK words of the source's documents, put in a shuffled order one after the other and, if the target
is larger than the source, once more from the start.

Ranks and positions are sums over chunks of bounded size plus a place within the chunk, so no source is
ever sorted or numbered as a whole.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import LAST_ID, saved, words

WEIGHTS, SHARE, MOST_TIMES = (3, 1, 2), (3, 2), 2
BLOCK = 256
#: 2**32, and that divided by the golden ratio (odd, so the points do not repeat before 2**32 slots).
POINTS, STEP = 1 << 32, 2654435769
#: Slots of a chunk; bits of a point that name its cell; hexadecimal digits that name a part of a source.
CHUNK, CELL, DIGITS = 1 << 12, 20, 3


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def targets(sizes: DataFrame) -> DataFrame:
    """(key, source_size, target, words, lo, hi) per source of sizes (key, source, size): one small row each.

    Weights repeat over the sources by code point, null last. A source's target is its weight's share of
    SHARE[0] / SHARE[1] of all words, at most MOST_TIMES its own size; what is too much goes to the others by
    weight. words is the whole part of target, [lo, hi) the source's points.
    """
    sources = sizes.groupBy("key").agg(F.min("source").alias("source"), F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(in_order) - 1) % len(WEIGHTS))
    weighed = sources.withColumn("weight", weight).withColumn("cap", MOST_TIMES * F.col("source_size"))
    lcm = 1
    for w in WEIGHTS:
        lcm = lcm * w // next(d for d in range(w, 0, -1) if lcm % d == 0 and w % d == 0)
    # Sources that reach their limit soonest come first; what they leave is shared by those behind them.
    soonest = Window.orderBy(F.call_function("div", F.col("cap") * lcm, F.col("weight")), F.col("source").asc_nulls_last())
    before = soonest.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(SHARE[0]) * F.sum("source_size").over(every) / F.lit(SHARE[1]) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    shared = weighed.withColumn("per", left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    shared = shared.withColumn("place", F.row_number().over(soonest))
    first = F.min(F.when(F.col("per") * F.col("weight") <= F.col("cap"), F.struct("place", "per"))).over(every)
    level = shared.withColumn("level", first)
    free = F.col("place") >= F.col("level.place")
    aimed = level.withColumn("target", F.when(free, F.col("level.per") * F.col("weight")).otherwise(F.col("cap")).cast("double"))
    aimed = aimed.withColumn("words", F.floor("target"))
    upto = F.sum("words").over(in_order)
    total = F.sum("words").over(every)

    def point(words: Column) -> Column:
        return F.when(total > 0, F.floor(words.cast("decimal(20,0)") * F.lit(POINTS).cast("decimal(11,0)") / total.cast("decimal(20,0)")).cast("long"))

    return aimed.select("key", "source_size", "target", "words", point(upto - F.col("words")).alias("lo"), point(upto).alias("hi"))


def schedule(spark, aims: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, key, rank): which source each slot takes from, and the slot's rank among the source's."""
    total = aims.agg(F.sum("words")).first()[0] or 0
    point = F.pmod(F.pmod(F.col("id"), F.lit(POINTS)) * STEP, F.lit(POINTS))
    slots = spark.range(ceil(total / block)).select(F.col("id").alias("slot"), point.alias("point"))
    slots = slots.withColumn("cell", F.shiftright("point", CELL))
    parts = aims.where("lo < hi").withColumn("cell", F.explode(F.sequence(F.shiftright("lo", CELL), F.shiftright(F.col("hi") - 1, CELL))))
    given = slots.join(parts.select("key", "lo", "hi", "cell"), "cell").where("point >= lo and point < hi")
    given = given.select("slot", "key", F.call_function("div", F.col("slot"), F.lit(CHUNK)).alias("chunk"))
    counts = given.groupBy("key", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("key", "chunk").orderBy("slot")) - 1
    return given.withColumn("place", place).join(counts, ["key", "chunk"]).select("slot", "key", (F.col("earlier") + F.col("place")).alias("rank"))


def placed(sizes: DataFrame) -> DataFrame:
    """sizes with part, row and start: each document's place in the shuffled order of its source, in words."""
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    dealt = sizes.withColumn("mark", mark).withColumn("part", F.substring("mark", 1, DIGITS))
    sums = dealt.groupBy("key", "part").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("key", "part").orderBy("mark", "doc_id", "size")
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    numbered = dealt.withColumn("inside", inside).withColumn("row", F.row_number().over(order))
    return numbered.join(offsets, ["key", "part"]).select("doc_id", "key", "size", "part", "row", (F.col("offset") + F.col("inside")).alias("start"))


def mixed_words(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """What the mix takes: (slot, doc_id, key, size, source_size, target, part, row, first_word, taken).

    One row for each piece of a document in a slot's block, and one with slot null for every document, with
    nothing taken, so that no document is missing. key, part and row name a row of docs.
    Null and blank texts have size 0. Null sources are one source, the last. Rows without doc_id are
    shuffled as one id. Repeated rows are rows of their own; ties in the shuffled order go by size,
    and equal rows are interchangeable. Only doc_id, text and source are looked at. An empty table gives
    an empty table. The same rows give the same mix, however they are stored.
    """
    spark = docs.sparkSession
    sizes = saved(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _key(F.col("source")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("size")),
        "sizes",
    )
    aims = saved(targets(sizes), "aims")
    slots = schedule(spark, aims, block)
    of_source = aims.select("key", "source_size", "target", "words")
    # The sums by part hold a row for at most 16**DIGITS parts of a source, so the join deals out its hot source.
    rows = placed(sizes).join(of_source, "key")
    rounds = F.explode(F.sequence(F.lit(0), F.lit(MOST_TIMES - 1)))
    spans = rows.where("size > 0").withColumn("round", rounds).withColumn("from", F.col("start") + F.col("round") * F.col("source_size"))
    spans = spans.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("words"))).where("from < to")
    div = lambda a: F.call_function("div", a, F.lit(block))
    pieces = spans.withColumn("rank", F.explode(F.sequence(div(F.col("from")), div(F.col("to") - 1))))
    first = F.greatest(F.col("from"), F.col("rank") * block)
    pieces = pieces.withColumn("first_word", first - F.col("from")).withColumn("taken", F.least(F.col("to"), (F.col("rank") + 1) * block) - first)
    taken = pieces.join(slots, ["key", "rank"])
    columns = ["doc_id", "key", "size", "source_size", "target", "part", "row"]
    return taken.select("slot", *columns, "first_word", "taken").unionByName(
        rows.select(F.lit(None).cast("long").alias("slot"), *columns, F.lit(0).cast("long").alias("first_word"), F.lit(0).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of docs; edge cases as in mixed_words()."""
    rows = mixed_words(docs, block)
    sums = rows.groupBy("key", "part", "row", "doc_id", "size", "source_size", "target").agg(F.sum("taken").alias("taken"))
    return sums.select("doc_id", "size", "source_size", "target", "taken")


def mixed_copies(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of docs as often as the mix takes them, rounded to whole documents, with all their columns.

    Rows of one doc_id are taken equally often; documents without words are not taken.
    """
    rank = lambda c: F.coalesce(c, F.lit(LAST_ID))
    times = mixed_documents(docs, block).groupBy(rank(F.col("doc_id")).alias("id")).agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
    times = times.where("2 * t >= s and s > 0").select("id", F.call_function("div", 2 * F.col("t") + F.col("s"), 2 * F.col("s")).cast("int").alias("times"))
    # The whole row is one column here, so no name of its own can clash.
    met = docs.select(F.struct("*").alias("given"), rank(F.col("doc_id").cast("long")).alias("id")).join(times, "id")
    return met.select("given", F.explode(F.sequence(F.lit(1), F.col("times")))).select("given.*")
