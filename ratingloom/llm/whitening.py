"""Whitening of vectors through distributed block matrices.

Entries are put on a grid of whole numbers, so that counts, sums and equality of vectors are exact. The fit list holds each
distinct vector once, indexed by the place of its first row. Its centred rows become a block matrix; the
transpose times the matrix is the scatter, whose row blocks are dealt to many tasks and only the sums of
width x width come to the driver for a local ``eigh``. A second block matrix, of all rows, times the whitening matrix projects every
row. Rows keep their index through both, so results are joined by a key that no two rows share, whatever is repeated.

Vectors that are null or hold null or non-finite entries are left out. Entries beyond the range of 64-bit
numbers on the grid are set to its ends. Vectors of another length than the most common one (the shorter of two equally common)
cannot be projected: each comes back once, with null component and values. Repeated rows are returned each,
and count once in the fit. A null vec_id stays null. If the fit list varies in fewer directions than are
asked for, ``whitened`` of the others is null; if it does not vary at all, so are ``explained`` and
``identity_error``. An exact value that no 64-bit number holds is null. An empty table gives an empty result;
vectors without entries have no component. Further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.llm.common import release
from ratingloom.sources.durable import durable

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
BLOCK = 1024  # rows and columns of a block
TASK_BLOCKS = 16  # row blocks that one task of the scatter multiplies
LIMIT = float(1 << 62)  # ends of the grid
FLAT = 1e-12  # share of the trace below which a direction does not vary
WIDE = "decimal(38,0)"
RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def on_grid(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x array<bigint>) of the usable vectors: ``floor(scale * entry) + shift``."""
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def entry(c: Column) -> Column:
        return F.floor(F.least(F.greatest(c * F.lit(float(scale)), F.lit(-LIMIT)), F.lit(LIMIT))).cast("bigint") + F.lit(shift).cast("bigint")

    return v.filter(F.col("v").isNotNull() & fine).select("vec_id", F.transform("v", entry).alias("x"))


def indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``idx``: a number of its own for each row, without sorting or gathering them.

    Each written part gets a stretch as long as the longest part needs, so numbers have gaps but
    no block of the matrix is empty but at the end of a part.
    """
    spread = durable(rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    stretch = spread.agg(F.max("_row")).first()[0]
    return spread.withColumn("idx", F.col("_part").cast("bigint") * F.lit((stretch or 0) + 1) + F.col("_row")).drop("_part", "_row")


def block_matrix(rows: DataFrame, width: int) -> BlockMatrix:
    """A block matrix of ``rows`` (idx, values array<double> of ``width``); indices without a row are zero.

    Rows of a block meet in one task, which hands on the block as bytes.
    """

    def gather(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        dense = np.zeros((BLOCK, width))
        dense[t.column("idx").to_numpy() % BLOCK] = t.column("values").combine_chunks().flatten().to_numpy().reshape(-1, width)
        return pa.table({"block": [key[0]], "dense": pa.array([dense.tobytes("F")], pa.binary())})

    block = F.floor(F.col("idx") / BLOCK).cast("bigint").alias("block")
    dense = rows.select(block, "idx", "values").groupBy("block").applyInArrow(gather, "block bigint, dense binary")
    cuts = [(c, min(BLOCK, width - c)) for c in range(0, width, BLOCK)]

    def cut(r) -> list:
        whole = np.frombuffer(r.dense)
        return [((r.block, c // BLOCK), DenseMatrix(BLOCK, n, whole[c * BLOCK : (c + n) * BLOCK])) for c, n in cuts]

    last = rows.agg(F.max("idx")).first()[0] or 0
    return BlockMatrix(dense.rdd.flatMap(cut), BLOCK, BLOCK, (last // BLOCK + 1) * BLOCK, width)


def scatter(m: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, with the row blocks split among tasks."""
    java = m.transpose()._java_matrix_wrapper  # the wrapper of multiply() has no number of splits
    splits = max(1, -(-m.numRowBlocks // TASK_BLOCKS))
    product = java.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, BLOCK, BLOCK).toLocalMatrix().toArray()


def times(m: BlockMatrix, w: np.ndarray, spark: SparkSession) -> DataFrame:
    """(idx, values) of the rows of matrix times ``w``."""
    parts = [((a // BLOCK, 0), DenseMatrix(len(w[a : a + BLOCK]), w.shape[1], w[a : a + BLOCK].ravel("F"))) for a in range(0, len(w), BLOCK)]
    right = BlockMatrix(spark.sparkContext.parallelize(parts, 1), BLOCK, w.shape[1])

    def rows(block) -> list:
        (at, _), matrix = block
        return [(at * BLOCK + k, v) for k, v in enumerate(matrix.toArray().tolist())]

    return m.multiply(right).blocks.flatMap(rows).toDF("idx bigint, values array<double>")


@dataclass
class Fit:
    """What is known of the fit list. ``sums`` are exact; ``matrix`` (width x components) whitens centred rows."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    trace: float
    matrix: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def centred(x: Column, mean: np.ndarray) -> Column:
    return F.zip_with(x, F.lit(mean.tolist()).cast("array<double>"), lambda a, m: a.cast("double") - m)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit:
    """``rows`` (idx, x): distinct vectors of one length."""
    spark = rows.sparkSession
    entries = rows.select(F.posexplode("x").alias("at", "x"))
    sums = entries.groupBy("at").agg(F.sum(F.col("x").cast("decimal(19,0)")).alias("s"), F.count("*").alias("n")).orderBy("at").collect()
    n, exact = sums[0].n, [int(r.s) for r in sums]
    mean = np.array([s / n for s in exact])
    v = scatter(block_matrix(rows.select("idx", centred(F.col("x"), mean).alias("values")), len(exact))) / n
    release(spark)
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors, trace = np.maximum(values[order], 0), vectors[:, order], float(np.trace(v))
    flat = values <= FLAT * trace
    matrix = np.where(flat, 0, vectors / np.sqrt(np.where(flat, 1, values)))
    return Fit(n, exact, values, trace, matrix)


def identity_error(projected: DataFrame, found: Fit) -> float | None:
    """Largest entry of the covariance of ``projected`` (idx, values) minus the identity, over directions that vary."""
    varies = np.abs(found.matrix).sum(0) > 0
    if not varies.any():
        return None
    k = len(varies)
    mean = projected.agg(*[F.avg(F.col("values")[c]).alias(f"m{c}") for c in range(k)]).first()
    cov = scatter(block_matrix(projected.select("idx", centred(F.col("values"), np.array([*mean])).alias("values")), k)) / found.n
    return float(np.abs(cov[np.ix_(varies, varies)] - np.eye(varies.sum())).max())


def _deviation(x: Column, found: Fit) -> Column:
    """Sum of the squares of n * x - S, in decimals; null where no 64-bit number holds it."""

    def square(a: Column, s: Column) -> Column:
        d = F.try_subtract(F.try_multiply(a.cast("decimal(19,0)"), F.lit(found.n).cast("decimal(19,0)")), s)
        return F.try_multiply(d.try_cast("decimal(19,0)"), d.try_cast("decimal(19,0)")).cast(WIDE)

    sums = F.array(*[F.lit(str(s)).cast(WIDE) for s in found.sums])
    total = F.aggregate(F.zip_with(x, sums, square), F.lit(0).cast(WIDE), lambda t, q: F.try_add(t, q).cast(WIDE))
    return total.try_cast("bigint")


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """For every usable row of ``vectors`` (vec_id, embedding) and component its whitened value.

    ``whitened`` has variance one over the fit list; ``n`` is its length, ``deviation`` the exact sum of (n * x - S)^2 over
    the dimensions, ``explained`` the component's share of the variance, and ``identity_error`` tells how far the
    covariance of the whitened fit list is from the identity.
    """
    spark = vectors.sparkSession
    rows = indexed(on_grid(vectors, scale, shift))
    width = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if width is None:
        return spark.createDataFrame([], RESULT)
    usable = rows.filter(F.size("x") == width.width)
    others = rows.filter(F.size("x") != width.width).select("vec_id", *_nulls())
    if width.width == 0:
        return usable.select("vec_id", *_nulls()).union(others)
    distinct = durable(usable.groupBy("x").agg(F.min("idx").alias("idx")))
    release(spark)
    found = fit(distinct, components)
    projected = durable(times(block_matrix(usable.select("idx", centred(F.col("x"), found.mean).alias("values")), width.width), found.matrix, spark))
    release(spark)
    error = identity_error(distinct.select("idx").join(projected, "idx"), found)
    release(spark)
    k = found.matrix.shape[1]
    varies = (np.abs(found.matrix).sum(0) > 0).tolist()
    share = (found.eigenvalues / found.trace).tolist() if found.trace > 0 else [None] * k
    told = usable.select("idx", "vec_id", _deviation(F.col("x"), found).alias("deviation")).join(projected, "idx", "left")
    each = F.array(*[
        F.struct(
            F.lit(c + 1).alias("component"),
            (F.coalesce(F.col("values")[c], F.lit(0.0)) if varies[c] else F.lit(None).cast("double")).alias("whitened"),
            F.lit(share[c]).cast("double").alias("explained"),
        )
        for c in range(k)
    ])
    out = told.select("vec_id", "deviation", F.explode(each).alias("c")).select(
        "vec_id",
        F.col("c.component").cast("int").alias("component"),
        F.lit(found.n).cast("bigint").alias("n"),
        "deviation",
        "c.whitened",
        "c.explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
    return out.union(others)


def _nulls() -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in (part.split() for part in RESULT.split(", ")[1:])]
