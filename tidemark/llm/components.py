"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import dropped, saved


#: Edges that one file of a stored table holds at least, so that small tables do not become many small files.
FILE = 250_000


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(vertex, root) of every vertex of edges (a, b): longs, root the smallest vertex it reaches.

    Alternates two steps until nothing changes, so the number of rounds grows with the logarithm of
    the longest path. Each edge moves to the smallest neighbour of one of its ends. The smallest
    neighbour comes from a partial aggregate, and it is joined back as a stored table, so that a vertex
    with a third of all edges is pre-aggregated and then split by the adaptive skew join.
    An empty table gives an empty table; loops and repeated edges do no harm.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    state = _state(now)
    for _ in range(rounds):
        after = _towards_smallest(now, 1 + state[0] // FILE)
        then = _state(after)
        dropped(now)
        now = after
        if then == state:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        state = then
    raise RuntimeError(f"components: not settled after {rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges, as one small row."""
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(mark % 1000003), F.bit_xor(mark)).first())


def _towards_smallest(edges: DataFrame, files: int) -> DataFrame:
    """Links the larger neighbours of each vertex, then the smaller ones, to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = saved(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).coalesce(files), "smallest")
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(smallest, "a")
    larger = saved(larger.select(F.col("v").alias("a"), F.col("m").alias("b")).coalesce(files), "larger")
    smaller = larger.join(larger.groupBy("a").agg(F.min("b").alias("m")), "a")
    moved = smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).union(smaller.select("a", F.col("m").alias("b")))
    out = saved(moved.where("a > b").distinct().coalesce(files), "edges")
    for used in (smallest, larger):
        dropped(used)
    return out
