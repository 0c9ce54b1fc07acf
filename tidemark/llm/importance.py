"""Importance resampling: documents kept in proportion to how much likelier good text is to hold their n-grams.

Words, signs and pairs of them are hashed into BUCKETS buckets. Two generative models give each bucket a probability:
one of the target text (documents labelled good), one of the raw text (all documents). A document's weight is the
mean log ratio of the two over its n-grams, times EVIDENCE; adding Gumbel noise and taking the k largest
draws k documents without replacement with chances in proportion to the exponential of the weights.

k is the share of quality 1 among the labelled documents, times the number of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import mixed, saved, word_hashes

BUCKETS, SMOOTHING, EVIDENCE = 1 << 14, 1.0, 20.0
#: Bound of the sample the target model is fitted on: documents, those with the least hashes of doc_id.
TARGET_DOCS = 5000
SEED, FINE, FEW = 20, 4096, 20_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
NOTHING = -1e9


def gram_buckets(text: str | None) -> np.ndarray:
    """Buckets of a text's words, runs of signs, and adjacent pairs of these."""
    tokens = TOKEN.findall(text.lower()) if text else []
    if not tokens:
        return np.empty(0, np.int64)
    h = word_hashes([t.encode("utf-8", "replace") for t in tokens])
    with np.errstate(over="ignore"):
        pairs = mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    return (np.r_[h, pairs] % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(target, bucket, n) of rows (text, target): each task sends one row per bucket at most, for each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, target in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(gram_buckets(text.as_py()), minlength=BUCKETS)
                total[0] += found
                if target:
                    total[1] += found
        for kind in (0, 1):
            held = np.flatnonzero(total[kind])
            yield pa.record_batch([pa.array(np.full(len(held), bool(kind))), pa.array(held), pa.array(total[kind][held])], ["target", "bucket", "n"])

    counts = docs.select("text", "target").mapInArrow(run, "target boolean, bucket long, n long")
    return counts.groupBy("target", "bucket").agg(F.sum("n").alias("n"))


def log_ratios(docs: DataFrame, good: DataFrame) -> np.ndarray | None:
    """log(target probability / raw probability) of every bucket; none if there is no target text."""
    marked = docs.join(F.broadcast(good.select(F.col("doc_id").alias("__good")).limit(TARGET_DOCS)), docs["doc_id"] == F.col("__good"), "left")
    total = np.zeros((2, BUCKETS))
    for row in bucket_counts(marked.select("text", F.col("__good").isNotNull().alias("target"))).collect():  # 2 * BUCKETS rows at most
        total[int(row["target"]), row["bucket"]] = row["n"]
    if not total[1].any():
        return None
    chance = (total + SMOOTHING) / (total + SMOOTHING).sum(axis=1, keepdims=True)
    return np.log(chance[1]) - np.log(chance[0])


def noise(doc_id: Column) -> Column:
    """Standard Gumbel noise that an id always gets."""
    u = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(SEED)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def weighed(docs: DataFrame, ratios: np.ndarray | None) -> DataFrame:
    """(doc_id, n_grams, log_ratio, score, key); log_ratio is the mean over the n-grams, score its odds as a chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [gram_buckets(t.as_py()) for t in batch.column(1)]
            means = [float(ratios[b].mean()) if len(b) and ratios is not None else 0.0 if len(b) else None for b in found]
            yield pa.record_batch([batch.column(0), pa.array([len(b) for b in found], pa.int64()), pa.array(means, pa.float64())], ["doc_id", "n_grams", "log_ratio"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_grams long, log_ratio double")
    weight = EVIDENCE * F.col("log_ratio")
    return found.select(
        "*",
        F.coalesce(1 / (1 + F.exp(-weight)), F.lit(0.0)).alias("score"),
        F.coalesce(weight + noise(F.col("doc_id")), F.lit(NOTHING)).alias("key"),
    )


def _narrowed(scored: DataFrame, inside: Column, value: Column, left: int, whole: bool) -> tuple[Column, Column, int, int]:
    """The rows inside whose value is surely among the `left` largest, the rows in question, how many of these go on, how many there are.

    The range that holds the last of them is cut into FINE parts, and again, until few rows or one value are left in
    it. FINE counts at most come to the driver at a time. `whole` numbers are cut without rounding.
    """
    above = F.lit(False)
    low, high, n = scored.where(inside).agg(F.min(value), F.max(value), F.count("*")).first()
    inside = inside & (value >= low) & (value <= high)
    while n > FEW and low < high:
        step = (high - low) // FINE + 1 if whole else (high - low) / FINE
        if low + step == low:
            break
        if whole:
            part = F.call_function("div", value - F.lit(low), F.lit(step))
        else:
            part = F.least(F.floor((value - low) / step), F.lit(FINE - 1))
        counts = {r["part"]: r["n"] for r in scored.where(inside).groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
        for at in sorted(counts, reverse=True):
            if counts[at] >= left:
                break
            left -= counts[at]
        above = above | (inside & (part > at))
        inside = inside & (part == at)
        n = counts[at]
        low, high = scored.where(inside).agg(F.min(value), F.max(value)).first()
    return above, inside, left, n


def with_top(scored: DataFrame, k: int) -> DataFrame:
    """scored (a stored table) and `kept`: whether a row is among the k largest keys, ties by doc_id, rows without one last.

    Keys are narrowed down to the range that holds the k-th, and where very many rows have that very key, their ids
    likewise; only the few rows left are ordered. Nothing is sorted as a whole. Of very many rows with the
    same key and the same id, or none, which are one as good as the other, one task orders all.
    """
    n = scored.count()
    if k >= n or k <= 0:
        return scored.withColumn("kept", F.lit(bool(n) and k >= n))
    above, inside, left, n = _narrowed(scored, F.lit(True), F.col("key"), k, False)
    if n > FEW:
        first = F.coalesce(-F.col("doc_id").cast("decimal(21,0)"), F.lit(Decimal(-(2**63))).cast("decimal(21,0)"))
        by_id, inside, left, n = _narrowed(scored, inside, first, left, True)
        above = above | by_id
    rank = F.row_number().over(Window.orderBy(F.desc("key"), F.asc_nulls_last("doc_id")))
    edge = scored.where(inside).withColumn("kept", rank <= left)
    return edge.unionByName(scored.where(~inside).withColumn("kept", above))


def resampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_grams, log_ratio, score, key, kept) of every row of docs (doc_id, text).

    Good documents are the ids in labels (doc_id, quality, toxic) with quality 1 and not toxic: the target is learned
    from them. k is the share of quality 1, toxic ones included, among the labelled ids. Without any, all ratios are 0 and every document is kept. Null, empty and blank texts have no
    n-grams, a null log_ratio and score 0, and come last. Rows without doc_id get the same noise; equal
    rows get equal keys, and which of them is kept at the edge makes no difference. Other columns are not
    looked at. An empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    told = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    told = told.agg((F.min(F.col("quality") == 1) & F.min(F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("good"), F.min(F.col("quality") == 1).alias("quality"))
    share = told.agg(F.avg(F.col("quality").cast("int"))).first()[0]
    good = told.where("good").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_DOCS)
    ratios = log_ratios(docs, good) if share else None
    scored = saved(weighed(docs, ratios), "weighed")
    k = scored.count() if ratios is None else ceil(share * scored.count())
    return with_top(scored, k)
