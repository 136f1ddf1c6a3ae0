"""Embedding whitening with MLlib's BlockMatrix.

Every usable vector gets a dense row index; the centred rows go into distributed blocks
of ``ROWS`` x ``COLUMNS``.  The scatter matrix is the blocks' transpose times the blocks,
its middle dimension dealt over many tasks; only the dimensions x dimensions result
comes to the driver, where ``eigh`` finds the components.  The blocks times the whitening
matrix are the projected rows.  The covariance of the stored result, taken in the same
way, says how far it is from the identity.

Entries are scaled to whole numbers first, so sums and deviations are exact, and rows
are centred as (n x - S) / n before anything is multiplied, whatever their offset.

Cases: vectors that are null, empty, or hold a null, NaN or infinite entry are left out;
vectors of several lengths are an error, as no covariance exists; null and repeated ids
are rows like any other; a component without variance (fewer or equal vectors than
dimensions, constant entries) has null ``whitened``; a deviation beyond a long is null;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import load, partitions_for, stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
ROWS = 1024
COLUMNS = 256
_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x: whole numbers floor(64 c) + 1000000 of the vectors without gaps."""
    v = F.col(vector_col).cast("array<double>")
    entry = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    whole = lambda c: F.floor(c * SCALE) + F.lit(OFFSET)
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.size("v") > 0)
            .where(~F.exists("v", entry)).select("vec_id", F.transform("v", whole).alias("x")))


def indexed(rows: DataFrame) -> DataFrame:
    """``rows`` stored, with ``index`` from 0 without gaps: the number of rows of all
    partitions before, and the place in the row's own."""
    number = F.col("_id").cast("long")
    kept = stored(rows.withColumn("_id", F.monotonically_increasing_id()), "whiten_rows")
    kept = kept.withColumn("_part", F.shiftright(number, 33)).withColumn("_pos", number.bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted((r["_part"], r["n"]) for r in kept.groupBy("_part").agg(F.count("*").alias("n")).collect())  # a row per partition
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    table = rows.sparkSession.createDataFrame(starts, "_part long, _before long")
    return kept.join(F.broadcast(table), "_part").withColumn("index", F.col("_before") + F.col("_pos")).drop("_id", "_part", "_pos", "_before")


def blocks(rows: DataFrame, vector_col: str, n: int, width: int) -> BlockMatrix:
    """The rows (index, array of doubles) as a distributed matrix of n x width."""
    table = rows.select("index", array_to_vector(F.col(vector_col)).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(table, "vector"), n, width).toBlockMatrix(ROWS, min(width, COLUMNS))


def scatter(matrix: BlockMatrix, tasks: int) -> np.ndarray:
    """Transpose times matrix, as a local array of the matrix's width."""
    splits = max(1, min(tasks, -(-matrix.numRows() // ROWS)))
    turned = matrix.transpose()._java_matrix_wrapper
    product = turned.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    local = BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()
    return (local + local.T) / 2


def local_blocks(spark: SparkSession, a: np.ndarray, rows_per_block: int) -> BlockMatrix:
    """A small matrix as blocks that fit the columns of a large one."""
    cut = [((i, 0), Matrices.dense(len(p), a.shape[1], p.flatten(order="F").tolist()))
           for i, p in enumerate(a[j:j + rows_per_block] for j in range(0, len(a), rows_per_block))]
    return BlockMatrix(spark.sparkContext.parallelize(cut, len(cut)), rows_per_block, a.shape[1], *a.shape)


def indexed_rows(matrix: BlockMatrix) -> DataFrame:
    """index, projected: the rows of a distributed matrix."""
    table = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model).toDF("index", "vector")
    return table.select("index", vector_to_array("vector").alias("projected"))


def _long_array(values: list[int], kind: str) -> Column:
    return F.array(*[F.lit(str(v)).cast(kind) for v in values])


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per
    usable vector and component, components by falling variance."""
    spark = vectors.sparkSession
    rows = indexed(usable(vectors, id_col, vector_col))
    width = rows.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    n, d = width["n"], width["most"]
    if not n:
        return spark.createDataFrame([], _RESULT)
    if width["least"] != d:
        raise ValueError(f"vectors of {width['least']} to {d} entries have no common covariance")
    entries = rows.select(F.posexplode("x").alias("dim", "x")).groupBy("dim")
    dims = sorted(entries.agg(F.sum("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())  # one row per dimension
    sums = [r["s"] for r in dims]
    reach = sum(max(n * r["hi"] - r["s"], r["s"] - n * r["lo"]) ** 2 for r in dims)
    kind = "bigint" if reach < 1 << 63 else "decimal(38,0)"  # exact either way
    off = F.zip_with(F.col("x").cast(f"array<{kind}>"), _long_array(sums, kind), lambda x, s: x * F.lit(str(n)).cast(kind) - s)
    rows = rows.withColumn("off", off)
    square = F.aggregate("off", F.lit("0").cast(kind), lambda a, o: (a + o * o).cast(kind))
    rows = stored(rows.select("index", "vec_id", square.try_cast("bigint").alias("deviation"),
                              F.transform("off", lambda o: o.cast("double") / n).alias("centred")), "whiten_centred")
    matrix, tasks = blocks(rows, "centred", n, d), partitions_for(spark)
    variance = scatter(matrix, tasks) / n
    values, axes = np.linalg.eigh(variance)
    k = min(components, d)
    values, axes, trace = values[::-1][:k], axes[:, ::-1][:, :k], float(np.trace(variance))
    real = values > max(trace, 0) * d * np.finfo(float).eps
    turn = np.where(real, axes / np.sqrt(np.where(real, values, 1)), 0.0)
    projected = indexed_rows(matrix.multiply(local_blocks(spark, turn, matrix.colsPerBlock)))
    rows = stored(rows.select("index", "vec_id", "deviation").join(projected, "index"), "whiten_projected")
    error = identity_error(rows, n, real, tasks)
    shares = [float(max(v, 0.0) / trace) if trace > 0 else None for v in values]
    each = F.posexplode(F.arrays_zip("projected", F.lit(np.arange(k).tolist()).alias("c"),
                                     F.array(*[F.lit(x).cast("double") for x in shares]).alias("share"),
                                     F.array(*[F.lit(bool(x)) for x in real]).alias("real"))).alias("place", "e")
    return (rows.select("vec_id", "deviation", each)
            .select("vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    F.when(F.col("e.real"), F.col("e.projected")).alias("whitened"), F.col("e.share").alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))


def identity_error(rows: DataFrame, n: int, real: np.ndarray, tasks: int) -> float | None:
    """Largest absolute entry of the covariance of ``projected`` minus the identity,
    over the components that have variance."""
    if not real.any():
        return None
    k = len(real)
    entries = rows.select(F.posexplode("projected").alias("dim", "y")).groupBy("dim").agg(F.avg("y").alias("m"))
    means = F.array(*[F.lit(float(r["m"])) for r in sorted(entries.collect())])
    centred = rows.select("index", F.zip_with("projected", means, lambda y, m: y - m).alias("y"))
    covariance = scatter(blocks(centred, "y", n, k), tasks) / n
    return float(np.abs((covariance - np.eye(k))[np.ix_(real, real)]).max())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(load(spark, sf_dir, "embeddings"))
