"""Embedding whitening with MLlib's BlockMatrix.

Rows are centred, indexed without gaps and put into distributed blocks.  The
blocks' transpose times the blocks is the scatter matrix, of which only d x d
numbers reach the driver; a local symmetric eigendecomposition gives the
whitening matrix, and one more block product projects all rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.llm.common import cut

#: Rows and columns of a block; a block of doubles has at most 8 MB.
BLOCK = 1024
#: Row blocks whose products are summed in one task.
BLOCKS_A_TASK = 16


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds no null, NaN or infinity."""
    x = F.transform(vector, lambda v: v.cast("double"))
    return vector.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))


def quantised(embeddings: DataFrame, vector: str = "embedding", scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """``embeddings`` without rows whose vector is null or not finite; ``x``
    (array<long>) holds floor(scale * entry) + shift.  Empty vectors stay.  Rows with an
    entry whose number would need more than 53 bits go with the infinite ones."""
    scaled = F.transform(vector, lambda v: scale * v.cast("double"))
    fits = finite(F.col(vector)) & ~F.exists(scaled, lambda v: F.abs(v) >= 2.0**52)
    entries = F.when(fits, F.transform(scaled, lambda v: F.floor(v) + F.lit(shift).cast("long")))
    return embeddings.withColumn("x", entries).where("x IS NOT NULL")


def indexed(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``_index`` (long) from 0 without gaps, and their number.

    The rows are checkpointed, as a lost task's rows must not be numbered anew.
    Numbers within a partition follow its order; what stands before a partition is
    summed over one row per partition."""
    placed = cut(rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    before = F.sum("n").over(W.orderBy("_part")) - F.col("n")
    starts = sizes.select("_part", (before - F.col("_first")).alias("_shift"))
    n = sizes.agg(F.sum("n")).first()[0] or 0
    return placed.join(F.broadcast(starts), "_part").withColumn("_index", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift"), n


def blocks(rows: DataFrame, vector: str, n: int, d: int) -> BlockMatrix:
    """The ``n`` x ``d`` matrix of ``vector`` (array<double>) by ``_index``, kept while it is
    in use: each side of a product asks for it, and so does the next product."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("_index").alias("index"), array_to_vector(vector).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, d).toBlockMatrix(BLOCK, BLOCK).persist(StorageLevel.MEMORY_AND_DISK)


def product(a: BlockMatrix, b: BlockMatrix) -> BlockMatrix:
    """``a`` times ``b``.  The inner dimension is split, or the few blocks of a narrow
    result would each be one task over all of it."""
    splits = max(1, math.ceil(a.numColBlocks / BLOCKS_A_TASK))
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def scatter(a: BlockMatrix) -> np.ndarray:
    """``a`` transposed times ``a``."""
    return product(a.transpose(), a).toLocalMatrix().toArray()


def component_vectors(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns.  Values that
    are zero to double precision have no whitened direction and are left out."""
    e, v = np.linalg.eigh((cov + cov.T) / 2)
    e, v = e[::-1], v[:, ::-1]
    there = int((e > len(e) * np.finfo(float).eps * max(e[0], 0)).sum()) if len(e) else 0
    most = min(components, there)
    return e[:most], v[:, :most]


def whiten(rows: DataFrame, vector: str = "x", key: str = "vec_id", components: int = 8) -> DataFrame:
    """For each row and component: ``key, component, n, deviation, whitened, explained, identity_error``.

    ``vector`` is array<long> without nulls.  All rows are the fit list.  Sums and
    deviations (sum over dimensions of (n*x - S)^2) are exact; a deviation beyond
    a long is null.  Components are numbered from 1 by falling eigenvalue;
    their sign is that of the entry of largest size, positive.  Those without
    variance are left out, so equal rows, or one row alone, give no rows.

    Vectors must have one length; rows of another than the most frequent one (of
    equally frequent ones the smaller), and empty vectors, take no part.  Repeated
    rows and null keys stay and count.  An empty table gives no rows; more columns
    are not looked at."""
    spark = rows.sparkSession
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = rows.select(F.col(key).alias("_key"), F.col(vector).alias("_x")).where(F.size("_x") > 0)
    usual = rows.groupBy(F.size("_x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if usual is None:
        return spark.createDataFrame([], schema)
    d = usual["d"]
    placed, n = indexed(rows.where(F.size("_x") == d))
    sums = placed.select(F.posexplode("_x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"))
    total = [r["s"] for r in sums.orderBy("i").collect()]  # one number per dimension
    s = F.array(*[F.lit(t).cast("decimal(38,0)") for t in total])
    off = F.zip_with("_x", s, lambda x, t: (F.lit(n).cast("decimal(19,0)") * x - t).cast("decimal(19,0)"))
    placed = placed.withColumn("_off", off)
    centred = placed.withColumn("_c", F.transform("_off", lambda o: o.cast("double") / n))
    matrix = blocks(centred, "_c", n, d)
    cov = scatter(matrix) / n
    e, v = component_vectors(cov, components)
    if not len(e):
        return spark.createDataFrame([], schema)
    v = v * np.sign(v[np.abs(v).argmax(0), range(len(e))])
    w = v / np.sqrt(e)
    tiles = [((i, j), w[i * BLOCK : (i + 1) * BLOCK, j * BLOCK : (j + 1) * BLOCK]) for i in range(math.ceil(d / BLOCK)) for j in range(math.ceil(len(e) / BLOCK))]
    parts = [(at, DenseMatrix(*t.shape, t.ravel("F"))) for at, t in tiles]
    projection = BlockMatrix(spark.sparkContext.parallelize(parts, len(parts)), BLOCK, BLOCK, d, len(e))
    projected = product(matrix, projection)
    z = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    z = cut(z.select(F.col("index").alias("_index"), vector_to_array("vector").alias("_z")))
    means = z.select(F.posexplode("_z").alias("i", "z")).groupBy("i").agg(F.avg("z").alias("m"))
    mean = F.array(*[F.lit(r["m"]) for r in means.orderBy("i").collect()])
    again = scatter(blocks(z.withColumn("_z", F.zip_with("_z", mean, lambda a, m: a - m)), "_z", n, len(e))) / n
    error = float(np.abs(again - np.eye(len(e))).max())
    squares = F.aggregate("_off", F.lit(0).cast("decimal(38,0)"), lambda a, o: (a + o * o).cast("decimal(38,0)"))
    deviation = F.expr("try_cast(_d AS long)")
    share = F.element_at(F.array(*[F.lit(float(x / cov.trace())) for x in e]), F.col("component"))
    out = placed.select("_index", "_key", squares.alias("_d")).join(z, "_index")
    return out.select(F.col("_key").alias(key), deviation.alias("deviation"), F.posexplode("_z").alias("i", "whitened")).withColumn("component", F.col("i") + 1).select(
        key, "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error")
    )
