"""Whitened embeddings by distributed block matrices.

Entries become integers (floor of a scaled entry, plus a shift). The centred
rows get consecutive numbers and go into an MLlib ``BlockMatrix``; transposed
times itself it gives the scatter matrix, whose eigenvectors are found locally
(a matrix of dimensions by dimensions), and a second block multiplication by
the whitening matrix projects the rows. A third one checks the result: the
covariance of what was projected against the identity.

Centring subtracts the whole part of the mean as integers first, so a large
shift costs no digits. Deviations are summed in 38-digit decimals.

Defined cases: a row whose vector is null or holds a null or a non-finite entry
is dropped; a vector shorter than the longest counts as padded with zeros;
scaled entries beyond 10^15 count as that; a null id stays a null id, and rows
that repeat an id or a vector are rows of their own; a direction without
variance (within rounding) can't be whitened and isn't returned, so a table of
one row or of equal rows gives no rows, like an empty one; a deviation beyond
64 bits is null; further columns are not read.

Scale: sums, scatter and projection are grouped sums and block products; the
middle dimension of transposed products is split, so no task gathers all
blocks. The driver holds a few numbers a dimension, matrices of dimensions by
dimensions, a count for each written partition, and (in MLlib) a pair of
integers for each block of ``ROWS`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.tables import Scratch

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
ROWS = 2048                # of a block
MIDDLE = 8                 # blocks of rows that one task multiplies
_LIMIT = 1e15
_RESULT = ("id {}, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def usable(vector: Column) -> Column:
    """Whether a vector is there and every entry is a finite number."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~bad


def _integers(vector: Column, scale: int, shift: int) -> Column:
    inside = lambda c: F.greatest(F.lit(-_LIMIT), F.least(F.lit(_LIMIT), c * scale))
    return F.transform(vector, lambda c: F.floor(inside(c)).cast("long") + shift)


@dataclass
class Fit:
    n: int
    sums: list[int]
    values: np.ndarray      # eigenvalues of the components, falling
    matrix: np.ndarray      # dimensions x components: unit eigenvectors over the roots of the values
    trace: float


def _numbered(work: Scratch, rows: DataFrame) -> DataFrame:
    """``rows`` with consecutive numbers from 0 in ``index``. A row's place in its
    written partition is known; each partition needs the count of those before."""
    rows = work.write(rows.withColumn("place", F.monotonically_increasing_id()), "rows")
    part = F.shiftright("place", 33)
    sizes = sorted((r["part"], r["n"]) for r in
                   rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, start = [], 0
    for p, n in sizes:
        before.append((p, start))
        start += n
    starts = rows.sparkSession.createDataFrame(before, "part long, start long")
    return (rows.withColumn("part", part).join(starts, "part")
            .withColumn("index", F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1))
            .drop("part", "place", "start"))


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left * right with the middle dimension dealt over ``splits`` groups of
    tasks; Python's own ``multiply`` lacks that parameter of the Scala method."""
    found = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(found, left.rowsPerBlock, right.colsPerBlock)


def _gram(matrix: BlockMatrix) -> np.ndarray:
    splits = max(1, matrix.numRowBlocks // MIDDLE)
    found = _product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()
    return (found + found.T) / 2


def _eigen(scatter: np.ndarray, n: int, sums: list[int], components: int) -> Fit:
    values, vectors = np.linalg.eigh(scatter / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    least = values[0] * len(values) * 10 * np.finfo(float).eps if len(values) else 0.0
    k = int((values[:components] > max(least, 0.0)).sum())
    return Fit(n, sums, values[:k], vectors[:, :k] / np.sqrt(values[:k]), float(np.trace(scatter) / n))


def _deviation(fit_n: int, whole: list[int], rest: list[int]) -> Column:
    """Sum over dimensions of (n*x - S)^2, with S = n*whole + rest."""
    wide = lambda c: c.cast("decimal(38,0)")
    rests = F.array(*[wide(F.lit(r)) for r in rest])
    wholes = F.array(*[F.lit(w).cast("long") for w in whole])
    small = F.zip_with("x", wholes, lambda x, w: x - w)
    parts = F.zip_with(small, rests, lambda x, r: F.try_subtract(F.try_multiply(x.cast("decimal(18,0)"),
                                                                               F.lit(fit_n).cast("decimal(18,0)")), r))
    square = lambda total, p: wide(F.try_add(total, F.try_multiply(wide(p), wide(p))))
    return F.aggregate(parts, wide(F.lit(0)), square).try_cast("long")


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
             shift: int = SHIFT, components: int = COMPONENTS) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained and
    identity_error of every usable row and component."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(usable(F.col("v"))).select("id", _integers(F.col("v"), scale, shift).alias("x")))
    work = Scratch(spark, "whitening")
    rows = _numbered(work, rows)
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n or not dims:
        return spark.createDataFrame([], _RESULT.format(kind))
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(shift).cast("long"), F.lit(dims) - F.size("x"))))
    sums = {r["pos"]: int(r["s"]) for r in rows.select(F.posexplode("x").alias("pos", "c"))
            .groupBy("pos").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s")).collect()}
    sums = [sums[k] for k in range(dims)]
    whole = [s // n for s in sums]
    rest = [s - n * w for s, w in zip(sums, whole, strict=True)]

    wholes = F.array(*[F.lit(w).cast("long") for w in whole])
    fractions = F.array(*[F.lit(float(Fraction(r, n))) for r in rest])
    centred = F.zip_with(F.zip_with("x", wholes, lambda x, w: (x - w).cast("double")), fractions, lambda x, f: x - f)
    indexed = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(centred).alias("v")), "v")
    matrix = IndexedRowMatrix(indexed, n, dims).toBlockMatrix(ROWS, dims)
    fit = _eigen(_gram(matrix), n, sums, components)
    k = len(fit.values)
    if not k:
        return spark.createDataFrame([], _RESULT.format(kind))

    whitening = Matrices.dense(dims, k, fit.matrix.ravel(order="F").tolist())
    projected = _product(matrix, BlockMatrix(spark.sparkContext.parallelize([((0, 0), whitening)], 1), dims, k), 1)

    def rows_of(block):
        (at, _), values = block
        return [(at * ROWS + j, row) for j, row in enumerate(values.toArray().tolist())]
    found = work.write(spark.createDataFrame(projected.blocks.flatMap(rows_of), "index long, values array<double>"),
                       "projected")
    error = float(np.abs(_gram(projected) / n - np.eye(k)).max())
    explained = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values])
    return (rows.select("index", "id", _deviation(n, whole, rest).alias("deviation")).join(found, "index")
            .select("id", "deviation", F.posexplode("values").alias("at", "whitened"))
            .select("id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(explained, F.col("at")).alias("explained"),
                    F.lit(error).alias("identity_error")))
