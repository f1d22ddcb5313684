"""PCA whitening of embeddings with distributed block matrices.

Entries become whole numbers ``x``, so their sums are exact. Rows are numbered, centred and laid into the blocks of a
``BlockMatrix``; the transposed matrix times the matrix is the scatter, a square of the dimension, which is decomposed
on the driver. The blocks times the whitening matrix are the projected rows. Nothing that grows with the number of rows
leaves the executors, but for the list of block numbers that the multiplication makes its plan from.

A row whose vector is null, or holds a null or an entry that is not finite, is left out. Vectors of unequal length fail
the job, and so does a deviation that a long cannot hold. Rows that repeat, also in their id, count and are returned
each; a null id stays. A component without variance cannot be whitened and has no rows; so an empty table, one vector
alone or copies of one vector give an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_ROWS = 2048  # rows of a block: a MB at 64 dimensions
SPLITS = 64  # partial scatters that are added up at the end, each a square of the dimension
RESULT = (
    "vec_id BIGINT, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"
)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def whole_numbers(rows: DataFrame) -> DataFrame:
    """``vec_id, x`` of all usable rows."""
    doubles = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
    x = F.transform("c", lambda c: F.floor(SCALE * c) + SHIFT)
    return doubles.filter(usable(F.col("c"))).select("vec_id", x.alias("x"))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with consecutive numbers from 0 in ``name``: place in its task and the rows of the tasks before.

    The rows are written first, so that numbers stay when a task is repeated. One count a task goes to the driver.
    """
    kept = stored(rows.withColumn(name, F.monotonically_increasing_id()), "numbered")
    task = F.shiftright(F.col(name), 33).cast("int")
    sizes, starts, total = kept.groupBy(task.alias("task")).count().collect(), [], 0
    for part, n in sorted(map(tuple, sizes)):
        starts.append((part, total))
        total += n
    first = kept.sparkSession.createDataFrame(starts, "task INT, first BIGINT")
    place = F.col(name).bitwiseAND((1 << 33) - 1) + F.col("first")
    return kept.withColumn("task", task).join(F.broadcast(first), "task").withColumn(name, place).drop("task", "first")


def literal(values, kind: str) -> Column:
    return F.lit([v.item() for v in values]).cast(f"array<{kind}>")


def block_matrix(rows: DataFrame, row: str, vector: str, n: int, size: int) -> BlockMatrix:
    """Blocks of ``BLOCK_ROWS`` whole rows of centred arrays."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(row, array_to_vector(F.col(vector)).alias("v")), "v")
    return IndexedRowMatrix(vectors, n, size).toBlockMatrix(BLOCK_ROWS, size)


def covariance(blocks: BlockMatrix, n: int) -> np.ndarray:
    """The scatter of centred rows over ``n``. The blocks are multiplied in ``SPLITS`` groups, added up where they are."""
    turned, splits = blocks.transpose(), min(SPLITS, -(-n // BLOCK_ROWS))
    product = turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    size = blocks.numCols()
    return BlockMatrix(product, size, size).toLocalMatrix().toArray() / n


def components(spread: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues in falling order and their unit vectors as columns, ``most`` at most, and the total variance."""
    values, vectors = np.linalg.eigh((spread + spread.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(most, int((values > len(values) * np.finfo(float).eps * max(values[0], 0)).sum()))
    return values[:kept], vectors[:, :kept], float(np.trace(spread))


def projected(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``row, w``: each row of ``blocks`` times ``matrix``."""
    spark, (size, k) = SparkSession.active(), matrix.shape
    local = spark.sparkContext.parallelize([((0, 0), DenseMatrix(size, k, matrix.ravel(order="F").tolist()))], 1)
    product = blocks.multiply(BlockMatrix(local, size, k, size, k))

    def rows(block):
        (at, _), values = block
        return [(at * BLOCK_ROWS + i, w) for i, w in enumerate(values.toArray().tolist())]

    return spark.createDataFrame(product.blocks.flatMap(rows), "row BIGINT, w ARRAY<DOUBLE>")


def whitened(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``RESULT``: a row for each usable vector of ``vec_id, embedding`` and each of its first ``most`` components."""
    spark = rows.sparkSession
    x = numbered(whole_numbers(rows), "row")
    sums = x.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    found = sorted(map(tuple, sums.collect()))  # as many rows as dimensions
    n = max((n for *_, n in found), default=0)
    if any(m != n for *_, m in found) or (found and not x.filter(F.size("x") == 0).isEmpty()):
        raise ValueError("vectors differ in length")
    if not found:
        return spark.createDataFrame([], RESULT)
    size = len(found)
    total = literal(np.array([s for _, s, _ in found], np.int64), "bigint")
    away = x.withColumn("away", F.zip_with("x", total, lambda a, s: n * a - s))
    square = F.aggregate("away", F.lit(0).cast("bigint"), lambda a, v: F.try_add(a, F.try_multiply(v, v)))
    too_large = F.raise_error(F.lit("a deviation is above the largest long")).cast("bigint")
    deviation = away.select("row", "vec_id", F.coalesce(square, too_large).alias("deviation"))
    blocks = block_matrix(away.withColumn("c", F.transform("away", lambda v: v / n)), "row", "c", n, size)
    blocks.persist(StorageLevel.MEMORY_AND_DISK)  # read four times; made anew where an executor is lost
    values, vectors, trace = components(covariance(blocks, n), most)
    k = len(values)
    w = stored(projected(blocks, vectors / np.sqrt(values)), "whitened") if k else None
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    if w is None:
        return spark.createDataFrame([], RESULT)
    means = w.select(F.posexplode("w").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("m")).orderBy("at").collect()
    centre = literal(np.array([r.m for r in means]), "double")
    centred = w.withColumn("c", F.zip_with("w", centre, lambda a, m: a - m))
    error = float(np.abs(covariance(block_matrix(centred, "row", "c", n, k), n) - np.eye(k)).max())
    shares = literal(values / trace, "double")
    out = deviation.join(w, "row").select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op11_embedding_whitening(spark, sf_dir):
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
