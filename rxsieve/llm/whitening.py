"""Whitening of vectors with MLlib's block matrices.

Rows are indexed, centred and dealt into blocks; the blocks' transpose times the blocks is the scatter matrix, whose eigenvectors are found locally (it is as large as a vector
is long, squared); the blocks times the whitening matrix are the projected rows. Products go through ``BlockMatrix.multiply`` with its middle
dimension split, so that no task holds the blocks of more than ``TOGETHER`` others.

Counts and sums are exact: an entry c is the whole number floor(64 c) + 1,000,000, and a row is centred as n x - S, a whole number too, before it is divided.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxsieve.llm.in_order import summaries
from rxsieve.llm.store import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Entries are cut off here, so that they are whole numbers both as long and as double.
LARGEST = float(1 << 52)
#: Numbers in a block, and blocks that one task multiplies.
NUMBERS, TOGETHER = 1 << 19, 16
#: Components whose eigenvalue is below so many times the largest have no direction.
RANK = 1e-10


def _kept(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite, F.lit(False))


def _indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``index``, from 0 without gaps: each part numbers its rows, and a row for each part tells how many come before."""
    schema = ", ".join(["part int, seq long", *(f"{c} {t}" for c, t in rows.dtypes)])

    def number(batches):
        seq, part = 0, None
        for batch in batches:
            if len(batch):
                part = batch.column("part")[0].as_py()
                yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(np.arange(seq, seq + len(batch))), *batch.columns[1:]], [f.name for f in target])
                seq += len(batch)
        if seq:
            # the summary: minus the number of rows
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([-seq]), *(pa.nulls(1, f.type) for f in target[2:])], [f.name for f in target])

    target = [pa.field("part", pa.int32()), pa.field("seq", pa.int64()), *(pa.field(f.name, pa.list_(pa.int64()) if f.name == "x" else pa.int64()) for f in rows.schema)]
    parts = stored(rows.select(F.spark_partition_id().alias("part"), "*").mapInArrow(number, schema), "indexed")
    before, starts = 0, []
    for row in summaries(parts):
        starts.append((row.part, before))
        before -= row.seq
    table = rows.sparkSession.createDataFrame(starts, "part int, start long")
    # a row for each part
    return parts.where("seq >= 0").join(F.broadcast(table), "part").select((F.col("start") + F.col("seq")).alias("index"), *rows.columns)


def _centred(n: int, sums: list[int]):
    """``index``, ``vec_id``, ``deviation`` and the centred entries; exact in numbers of 64 bits where these suffice and in Python's otherwise."""
    most = (1 << 62) - 1

    def centre(batches):
        for whole in batches:
            for at in range(0, len(whole), 4096):
                batch = whole.slice(at, 4096)
                x = batch.column("x")
                filled = np.zeros((len(batch), len(sums)), np.int64)
                sizes = x.value_lengths().to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                row = np.repeat(np.arange(len(batch)), sizes)
                place = np.arange(len(row)) - (ends - sizes)[row]
                filled[:] = SHIFT
                filled[row, place] = x.flatten().to_numpy()
                largest = max(abs(int(filled.max(initial=0))), abs(int(filled.min(initial=0))))
                wide = n * largest + max(map(abs, sums), default=0) > most
                off = filled.astype(object) * n - np.array(sums, object) if wide else filled * n - np.array(sums, np.int64)
                bound = int(np.abs(off).max(initial=0))
                wide = wide or bound * bound * max(1, len(sums)) > most
                squares = (off.astype(object) ** 2 if wide else off * off).sum(1) if len(sums) else np.zeros(len(batch), np.int64)
                deviation = pa.array([int(s) if s <= most * 2 + 1 else None for s in squares.tolist()], pa.int64())
                centred = off.astype(np.float64) / n
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * len(sums), pa.int32()), pa.array(centred.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("index"), batch.column("vec_id"), deviation, lists], ["index", "vec_id", "deviation", "centred"])

    return centre


def _blocks(centred: DataFrame, n: int, length: int) -> BlockMatrix:
    dense = centred.select("index", array_to_vector("centred").alias("vector"))
    rows = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(dense, "vector"), n, length)
    return rows.toBlockMatrix(max(1, NUMBERS // length), length)


def _product(one: BlockMatrix, other: BlockMatrix, splits: int) -> BlockMatrix:
    """``one.multiply(other)`` with the middle dimension in ``splits`` parts, which the Python class does not pass on."""
    java = one._java_matrix_wrapper.call("multiply", other._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, one.rowsPerBlock, other.colsPerBlock)


def _covariance(blocks: BlockMatrix, n: int) -> np.ndarray:
    splits = max(1, math.ceil(blocks.numRowBlocks / TOGETHER))
    return _product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray() / n


def _local(spark: SparkSession, matrix: np.ndarray) -> BlockMatrix:
    """A matrix of one block."""
    rows, columns = matrix.shape
    block = ((0, 0), DenseMatrix(rows, columns, matrix.ravel(order="F")))
    return BlockMatrix(spark.sparkContext.parallelize([block], 1), rows, columns, rows, columns)


def _whitening(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The whitening matrix, a column for each component, and the shares of variance, by falling eigenvalue."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = int(np.count_nonzero(values[:components] > max(0.0, RANK * values[0]))) if len(values) and values[0] > 0 else 0
    return vectors[:, :count] / np.sqrt(values[:count]), values[:count] / np.trace(covariance) if count else np.zeros(0)


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per vector and component ``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Vectors that are NULL or hold NULL or numbers that are not finite are dropped. All others are fitted and projected; rows alike and rows without vec_id are vectors
    of their own, and a vector shorter than the longest is filled up with zeros. Entries beyond 2**52 / 64 or so are cut off there. A
    deviation that no long holds is NULL. Components are as many as the vectors span, at most ``components``: none for no rows, for one row, or for equal rows.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    entry = lambda c: F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c * F.lit(float(SCALE))))) + SHIFT
    numbers = F.col(column).cast("array<double>")
    rows = vectors.where(_kept(numbers)).select("vec_id", F.transform(numbers, entry).alias("x"))
    indexed = stored(_indexed(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x")), "vectors")
    n, length = indexed.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    # decimals: exact beyond a long
    sums = indexed.agg(*(F.sum(F.coalesce(F.get("x", F.lit(k)), F.lit(SHIFT)).cast("decimal(20,0)")).alias(f"s{k}") for k in range(length))).first() if n and length else ()
    sums = [int(s) for s in sums]

    centred = stored(indexed.mapInArrow(_centred(max(1, n), sums), "index long, vec_id long, deviation long, centred array<double>"), "centred")
    empty = centred.select("vec_id", F.lit(0).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error"))).where(F.lit(False))
    if not n or not length:
        return empty
    blocks = _blocks(centred, n, length)
    matrix, shares = _whitening(_covariance(blocks, n), components)
    if not len(shares):
        return empty
    projected = _product(blocks, _local(spark, matrix), 1)
    error = float(np.abs(_covariance(projected, n) - np.eye(len(shares))).max())

    found = _rows(projected)
    share = F.element_at(F.array(*(F.lit(float(s)) for s in shares)), F.col("component"))
    each = found.join(centred.select("index", "vec_id", "deviation"), "index").select("vec_id", "deviation", F.posexplode("values").alias("place", "whitened"))
    each = each.withColumn("component", F.col("place") + 1)
    return each.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))


def _rows(matrix: BlockMatrix) -> DataFrame:
    """``index`` and ``values`` of the rows, handed over as a frame."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("values"))
