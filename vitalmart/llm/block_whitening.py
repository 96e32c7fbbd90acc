"""Whitening of embeddings with Spark MLlib's BlockMatrix.

Vectors become whole numbers, so distinct ones, their count and their sums are
exact. The distinct vectors, centred, are the indexed rows of a distributed
matrix cut into blocks; its transpose times itself is the scatter, whose size
is the square of the dimension and whose eigenvectors numpy finds on the
driver; the blocks times the whitening matrix are the projected rows. What
whitened rows' own covariance lacks to the identity is measured by a second
product of that kind.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.llm.common import lists, running_sums, saved, ship

#: Bytes of a block of the matrix, and blocks that one task multiplies.
BLOCK_BYTES, BLOCKS_A_TASK = 4 << 20, 8
_LONG = (1 << 63) - 1


def _centred(n: int, sums: list[int]):
    """(row, x) -> (row, x, centred, deviation); exact, in Python's integers
    where a long might not hold what comes up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column(1).flatten()).reshape(-1, len(sums))
            most = n * max(int(flat.max(initial=0)), -int(flat.min(initial=0))) + max(map(abs, sums), default=0)
            kind = np.int64 if most * most * max(len(sums), 1) < _LONG else object
            apart = flat.astype(kind) * n - np.array(sums, kind)
            deviation = [min(int(v), _LONG) for v in (apart * apart).sum(axis=1)]
            centre = (apart / n).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists(centre.ravel(), np.full(len(flat), len(sums)), pa.float64()),
                 pa.array(deviation, pa.int64())], ["row", "x", "centred", "deviation"])

    return run


def _blocks(rows: DataFrame, vector: str, n: int, dim: int) -> tuple[BlockMatrix, int]:
    """The rows (row: 0 to n - 1, vector) as a block matrix, and how many
    tasks should share a product over its rows."""
    high = max(256, min(BLOCK_BYTES // (8 * dim), math.ceil(n / 64)))
    indexed = MLUtils.convertVectorColumnsFromML(rows.select("row", array_to_vector(vector).alias("vector")), "vector")
    matrix = IndexedRowMatrix(indexed, n, dim).toBlockMatrix(high, dim)
    return matrix, math.ceil(math.ceil(n / high) / BLOCKS_A_TASK)


def _scatter(matrix: BlockMatrix, tasks: int) -> np.ndarray:
    """Transpose times matrix; the sum over the row blocks is split between
    ``tasks`` tasks, so that no task meets all rows."""
    left, right = (m._java_matrix_wrapper._java_model for m in (matrix.transpose(), matrix))
    done = BlockMatrix(left.multiply(right, tasks), matrix.colsPerBlock, matrix.colsPerBlock)
    return done.toLocalMatrix().toArray()


def _projected(spark: SparkSession, matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """(row, vector) of matrix times whitening; the rows stay in the JVM."""
    dim, k = whitening.shape
    block = ((0, 0), DenseMatrix(dim, k, whitening.ravel(order="F").tolist()))
    right = BlockMatrix(spark.sparkContext.parallelize([block], 1), dim, k, dim, k)
    rows = callMLlibFunc("getIndexedRows", matrix.multiply(right).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    done = MLUtils.convertVectorColumnsToML(rows, "vector")
    return done.select(F.col("index").alias("row"), vector_to_array("vector").alias("vector"))


def whitened(vectors: DataFrame, scale: int = 64, plus: int = 1_000_000, components: int = 16) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding) and component: vec_id,
    component (from 1), n (distinct vectors), deviation, whitened, explained,
    identity_error.

    An entry c counts as x = floor(scale * c) + plus. With n distinct x, their
    sums S and their covariance V (divisor n): deviation is the sum of
    (n * x - S) ** 2 over the dimensions, whitened the centred x projected on
    V's unit eigenvector of that number (by falling eigenvalue, the largest
    entry of each positive) over the root of the eigenvalue, explained the
    eigenvalue's share of V's trace, identity_error the largest entry of the
    whitened distinct rows' covariance minus the identity.

    Rows whose vector is null or empty or holds null or non-finite entries,
    and rows whose length isn't the most frequent one (the longer of two as
    frequent), take no part. Components of no variance (an eigenvalue within
    rounding of zero) have no whitened value and are left out: one distinct
    vector alone, or an empty table, gives no rows. Entries beyond a long stop
    there, as does a deviation. Repeated rows and vec_ids and null vec_ids
    give as many rows each. Other columns aren't read.
    """
    spark = vectors.sparkSession
    ship(spark)
    c = F.col("embedding")
    finite = (c.isNotNull() & (F.size(c) > 0)
              & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                         & (F.abs(v.cast("double")) < F.lit(float("inf")))))
    whole = F.transform(c, lambda v: F.try_add(F.floor(v.cast("double") * scale), F.lit(plus).cast("bigint")))
    whole = F.transform(whole, lambda v: F.coalesce(v, F.lit(_LONG)))
    sound = vectors.where(F.coalesce(finite, F.lit(False))).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("x"))
    often = (sound.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("rows"))
             .orderBy(F.desc("rows"), F.desc("dim")).first())
    empty = spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                                      "explained double, identity_error double")
    if often is None:
        return empty
    dim = often["dim"]
    sound = sound.where(F.size("x") == dim)

    # the fit list, numbered without a gap
    fit = running_sums(sound.select("x").distinct().select("x", F.xxhash64("x").alias("turn"), F.lit(1).cast("bigint").alias("one")),
                       ["turn"], ["one"]).select(F.col("one_before").alias("row"), "x")
    by_dim = (fit.select(F.posexplode("x").alias("at", "v")).groupBy("at")
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect())  # one row a dimension
    n, sums = by_dim[0]["n"], [int(r["s"]) for r in sorted(by_dim, key=lambda r: r["at"])]
    centred = saved(fit.mapInArrow(_centred(n, sums), "row bigint, x array<bigint>, centred array<double>, deviation bigint"))

    matrix, tasks = _blocks(centred, "centred", n, dim)
    value, vector = np.linalg.eigh(_scatter(matrix, tasks) / n)
    value, vector = value[::-1], vector[:, ::-1]
    vector = vector * np.sign(vector[np.abs(vector).argmax(axis=0), np.arange(dim)])
    trace = value.sum()
    k = int((value[:components] > max(trace, 0) * dim * np.finfo(float).eps).sum())
    if not k:
        return empty
    done = saved(_projected(spark, matrix, vector[:, :k] / np.sqrt(value[:k])))

    own, tasks = _blocks(done, "vector", n, k)
    middle = np.array([r["m"] for r in sorted(done.select(F.posexplode("vector").alias("at", "v")).groupBy("at")
                                              .agg(F.avg("v").alias("m")).collect(), key=lambda r: r["at"])])
    error = float(np.abs(_scatter(own, tasks) / n - np.outer(middle, middle) - np.eye(k)).max())

    of_fit = centred.select("row", "x", "deviation").join(done, "row").drop("row")
    share = F.array(*[F.lit(float(v)) for v in value[:k] / trace])
    return (sound.join(of_fit, "x")
            .select("vec_id", "deviation", F.posexplode("vector").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
