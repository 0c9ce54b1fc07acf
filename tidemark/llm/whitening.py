"""Embedding whitening with distributed block matrices.

Vectors are put on a grid of 1/256. Every distinct vector once makes the fit list: its rows, centred, are numbered and
packed into the blocks of a Spark MLlib BlockMatrix, and the product of its transpose with itself is the
scatter matrix. That is as wide as a vector is long, so its eigenvectors are found on the driver. All rows are packed
too, and the product of their BlockMatrix with the whitening matrix projects them.

MLlib deals the blocks of a product to tasks by their place in the grid of blocks; a matrix of one column of
blocks would meet in few of them. The scatter product is therefore split along its inner dimension, and for
the projection the blocks are laid out as a square, with the whitening matrix repeated along the diagonal
of the other factor: block (i, j) of the product is block (i, j) of the rows times the one matrix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import saved

GRID = 256
COMPONENTS = 4
#: The longest vector: a matrix of this width and height is held by the driver.
WIDEST = 4096
#: A block has so many rows at least; more where there would be too many blocks, up to so many bytes.
BLOCK_ROWS, MANY_BLOCKS, BLOCK_BYTES = 1024, 2**16, 2**26
#: Tasks of the scatter product, each with one partial sum.
SPLITS = 1024

PROJECTED = T.StructType([T.StructField("row", T.LongType()), T.StructField("values", T.ArrayType(T.DoubleType()))])


def whitened_rows(vectors: DataFrame, components: int = COMPONENTS, block_rows: int | None = None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Rows without a vector, or with a null or an entry that is not finite in it, are left out. A vector that is shorter
    than the longest counts as if zeros followed; more than WIDEST entries are refused. Equal vectors
    count once in the fit and get equal values; rows that repeat a vec_id, or have none, are rows like others.
    Components without variance (beyond rounding) cannot be whitened and are left out, so few distinct
    vectors give fewer rows, and a single one none. `deviation` is null where it, or n times an entry, does not
    fit a long. An empty table gives no rows. Other columns do not matter.
    """
    rows = _numbered(_on_grid(vectors), "vectors")
    least, width = (x or 0 for x in rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first())
    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries; {WIDEST} is the most")
    if least < width:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))))
    fit = _numbered(rows.select("x").distinct(), "fit-list")
    n = fit.count()
    sums = _sums(fit, width)
    if not n or not width:
        return _result(rows, None, n, sums, [], 0.0)
    packed = _packed(fit, n, sums, n, block_rows)
    values, axes, trace = _spectrum(packed, n)
    values, axes = values[:components], axes[:, :components]
    if not len(values):
        return _result(rows, None, n, sums, [], 0.0)
    scale = axes / np.sqrt(values)
    error = _identity_error(_projected(packed, scale), n)
    found = _projected(_packed(rows, rows.count(), sums, n, block_rows), scale).flatMap(_block_rows)
    found = vectors.sparkSession.createDataFrame(found, PROJECTED)
    return _result(rows, found, n, sums, [float(e / trace) for e in values], error)


def _on_grid(vectors: DataFrame) -> DataFrame:
    """vec_id and x: entries as whole steps of the grid."""
    entries = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    # A null entry makes the test null, and the row goes too.
    sound = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.where(F.col("embedding").isNotNull() & sound)
    return kept.select("vec_id", F.transform(entries, lambda c: F.floor(c * GRID)).alias("x"))


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """rows, stored, with a column `row` that counts them from 0 without gaps.

    The task and place that wrote a row are stored with it, so the numbers are the same whenever they are read.
    """
    stored = saved(rows.withColumn("written", F.monotonically_increasing_id()), name)
    task, place = F.shiftright("written", 33), F.col("written").bitwiseAND(2**33 - 1)
    sizes = stored.groupBy(task.alias("task")).agg(F.count("*").alias("size"))  # one row per task
    before = F.sum("size").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = saved(sizes.select("task", F.coalesce(before, F.lit(0)).alias("before")), f"{name}-offsets")
    joined = stored.withColumn("task", task).join(offsets, "task")
    return joined.select(*rows.columns, (F.col("before") + place).alias("row"))


def _sums(fit: DataFrame, width: int) -> list[int]:
    """Exact sums, by dimension."""
    entries = fit.select(F.posexplode("x").alias("i", "c"))
    found = entries.groupBy("i").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s")).collect()  # one row per dimension
    held = {r["i"]: int(r["s"]) for r in found}
    return [held.get(i, 0) for i in range(width)]


@dataclass(frozen=True)
class Packed:
    """Centred rows in blocks: a stored row per block, its entries by column."""

    blocks: DataFrame
    block_rows: int
    count: int
    width: int

    def placed(self, place) -> RDD:
        """((i, j), matrix) with (i, j) = place(number of the block)."""
        width = self.width

        def matrix(r):
            return place(r["block"]), DenseMatrix(r["size"], width, np.frombuffer(r["entries"]))

        return self.blocks.rdd.map(matrix)


def _packed(rows: DataFrame, count: int, sums: list[int], n: int, block_rows: int | None) -> Packed:
    """rows less their mean, sums / n, in blocks of equal height (but the last)."""
    width = len(sums)
    size = block_rows or min(max(BLOCK_ROWS, count // MANY_BLOCKS), max(BLOCK_BYTES // (8 * width), 1))
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        block, x = key[0].as_py(), table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, width)
        far = np.abs(x.astype(float)) > 2.0**61
        centred = np.where(far, x.astype(float) - whole, np.where(far, 0, x - whole)) - part
        placed = np.empty_like(centred)
        placed[table.column("row").to_numpy() - block * size] = centred
        entries = [placed.tobytes("F")]
        return pa.table([pa.array([block]), pa.array([len(x)], pa.int32()), pa.array(entries, pa.binary())], ["block", "size", "entries"])

    blocks = rows.select("x", "row", F.call_function("div", "row", F.lit(size)).alias("block")).groupBy("block")
    blocks = blocks.applyInArrow(pack, "block long, size int, entries binary")
    return Packed(saved(blocks, "blocks"), size, -(-count // size), width)


def _spectrum(packed: Packed, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues that are not rounding, falling, their unit vectors as columns, and the trace."""
    width = packed.width
    rows = BlockMatrix(packed.placed(lambda b: (b, 0)), packed.block_rows, width, n, width)
    splits = min(SPLITS, packed.count)
    product = rows.transpose()._java_matrix_wrapper.call("multiply", rows._java_matrix_wrapper._java_model, splits)
    scatter = BlockMatrix(product, width, width).toLocalMatrix().toArray() / n
    values, axes = np.linalg.eigh((scatter + scatter.T) / 2)
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(width)])
    real = values > max(values[0], 0) * width * np.finfo(float).eps
    return values[real], axes[:, real], float(np.trace(scatter))


def _projected(packed: Packed, scale: np.ndarray) -> RDD:
    """(first row, rows times scale) of every block."""
    side, size = max(1, math.ceil(math.sqrt(packed.count))), packed.block_rows
    width, k = scale.shape
    rows = BlockMatrix(packed.placed(lambda b: (b // side, b % side)), size, width, side * size, side * width)
    one = DenseMatrix(width, k, scale.ravel("F"))
    sc = packed.blocks.sparkSession.sparkContext
    diagonal = sc.parallelize(range(side), min(side, sc.defaultParallelism)).map(lambda j: ((j, j), one))
    product = rows.multiply(BlockMatrix(diagonal, width, k, side * width, side * k))
    return product.blocks.map(lambda b: ((b[0][0] * side + b[0][1]) * size, b[1].toArray()))


def _block_rows(block: tuple[int, np.ndarray]):
    first, values = block
    return [(first + i, v) for i, v in enumerate(values.tolist())]


def _identity_error(projected: RDD, n: int) -> float:
    """The largest entry, in size, of the covariance of what was projected less the identity."""

    def moments(block: tuple[int, np.ndarray]) -> np.ndarray:
        values = np.c_[block[1], np.ones(len(block[1]))]
        return values.T @ values

    total = projected.map(moments).treeReduce(lambda a, b: a + b) / n
    mean = total[:-1, -1]
    return float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max())


def _deviation(n: int, sums: list[int]) -> Column:
    """Sum over dimensions of (n * x - S)^2."""
    if any(abs(s) >= 2**63 for s in sums):
        return F.lit(None).cast("long")
    away = F.zip_with(
        "x",
        F.array(*[F.lit(s).cast("long") for s in sums]),
        lambda c, s: F.try_subtract(F.try_multiply(c, F.lit(n).cast("long")), s),
    )
    return F.aggregate(away, F.lit(0).cast("long"), lambda t, d: F.try_add(t, F.try_multiply(d, d)))


def _result(rows: DataFrame, found: DataFrame | None, n: int, sums: list[int], explained: list[float], error: float) -> DataFrame:
    if found is None:
        joined = rows.where(F.lit(False)).withColumn("values", F.array(F.lit(0.0)))
    else:
        joined = rows.join(found, "row")
    shares = F.array(*[F.lit(e) for e in explained or [0.0]])
    joined = joined.select("vec_id", _deviation(n, sums).alias("deviation"), F.posexplode("values").alias("at", "whitened"))
    return joined.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
