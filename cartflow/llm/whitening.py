"""Embedding whitening with MLlib's distributed block matrices.

Entries become whole numbers; the distinct vectors are numbered, centred and
cut into blocks of rows.  The transposed matrix times itself gives the scatter
(its long dimension split over many tasks), whose eigenvectors are found on
the driver: it has one row and column for each dimension.  A second block
multiplication by the whitening matrix projects the rows.

Vectors that are null or empty, hold null or non-finite entries, or entries of
64 * |c| over 2**53 (no exact whole number), are left out, and so are vectors
of another length than the commonest (of equally common ones, the longest).
Repeated rows count once in the fit and each get their result.  Components
whose eigenvalue is under 1e-9 of the trace carry no variance and have no
rows; one distinct vector, or an empty table, gives no rows.  ``deviation`` is
null where it passes 64 bits.  Other columns of the table are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, written

SCALE, SHIFT = 64, 1_000_000
LARGEST = 1 << 53
ROWS_PER_BLOCK = 4096
BLOCKS_PER_SPLIT = 16    # block rows that one task of the scatter multiplies
LEAST_SHARE = 1e-9
COMPONENTS = 16
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the usable vectors as arrays of whole numbers."""
    v = F.col(vector)
    # Comparisons with nan or infinity fail the bound, as nan is above all numbers.
    def entry(c):
        big = c.cast("double") * SCALE
        return F.when(F.abs(big) <= LARGEST, F.floor(big) + F.lit(SHIFT).cast("long"))

    x = F.transform(v, entry)
    whole = F.when((F.size(v) > 0) & F.forall(x, lambda c: c.isNotNull()), x)
    return embeddings.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x")).where("x is not null")


def blocks(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """The block matrix of rows (index, values)."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("values").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(ROWS_PER_BLOCK, width)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transposed matrix times matrix; the long dimension is split over many tasks."""
    wrapper = matrix.transpose()._java_matrix_wrapper
    splits = max(1, -(-matrix.numRowBlocks // BLOCKS_PER_SPLIT))
    product = wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def multiplied(matrix: BlockMatrix, right: np.ndarray) -> DataFrame:
    """(index, values) of the rows of ``matrix`` times a small matrix."""
    spark = matrix.blocks.ctx
    small = DenseMatrix(*right.shape, right.ravel(order="F"))
    other = BlockMatrix(spark.parallelize([((0, 0), small)], 1), *right.shape)
    rows = matrix.multiply(other).toIndexedRowMatrix()
    frame = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return frame.select("index", vector_to_array("vector").alias("values"))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and component."""
    spark = embeddings.sparkSession
    nothing = spark.createDataFrame([], RESULT)
    rows = whole_vectors(embeddings, id_col, vector)
    widths = rows.groupBy(F.size("x").alias("width")).count() \
        .orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not widths:
        return nothing
    width = widths[0]["width"]
    rows = rows.where(F.size("x") == width)
    fit = numbered(rows.select("x").distinct(), "index", "whitening-fit")
    exact = "decimal(38,0)"
    sums = fit.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max("x")).alias("high"),
                   F.min(F.array_min("x")).alias("low"),
                   *[F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]).first()
    n = sums["n"]
    if n < 2:
        return nothing
    total = [int(sums[f"s{i}"]) for i in range(width)]
    # Whole-number arithmetic in 64 bits where nothing can pass them, else in 38 digits.
    kind = "long" if n * max(abs(sums["high"]), abs(sums["low"])) < 1 << 62 else exact
    square_kind = "long" if width * (n * (sums["high"] - sums["low"])) ** 2 < 1 << 62 else exact
    offset = F.array(*[F.lit(str(s)).cast(kind) for s in total])
    off = F.zip_with("x", offset, lambda v, s: v.cast(kind) * F.lit(str(n)).cast(kind) - s)
    deviation = F.aggregate(F.transform("off", lambda v: v.cast(square_kind) * v.cast(square_kind)),
                            F.lit("0").cast(square_kind), lambda a, v: (a + v).cast(square_kind))
    centred = fit.select("index", "x", off.alias("off")).select(
        "index", "x", deviation.try_cast("long").alias("deviation"),
        F.transform("off", lambda v: v.cast("double") / F.lit(float(n))).alias("values"))
    centred = written(centred, "whitening-centred")
    matrix = blocks(centred, n, width)
    covariance = scatter(matrix) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    order = np.argsort(-values)[:components]
    order = order[values[order] > LEAST_SHARE * trace]
    if not len(order):
        return nothing
    projected = written(multiplied(matrix, vectors[:, order] / np.sqrt(values[order])), "whitening-projected")
    error = float(np.abs(scatter(blocks(projected, n, len(order))) / n - np.eye(len(order))).max())
    explained = F.array(*[F.lit(float(e / trace)) for e in values[order]])
    # Copies of a vector meet their one result in joins that Spark may split.
    found = rows.join(centred.select("index", "x", "deviation"), "x").select("vec_id", "index", "deviation")
    found = found.join(projected, "index")
    return found.select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
