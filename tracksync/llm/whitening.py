"""Whitening of vectors with MLlib's BlockMatrix.

1. Entries are brought to whole numbers; sums of all dimensions over the distinct vectors (the fit
   list) are exact, and every entry is centred exactly before it becomes a double.
2. Centred rows get dense numbers and go into a BlockMatrix of ``rows_per_block`` rows a block.  The
   fit list keeps the numbers of all rows: a repeated vector is a row of zeros there, which adds
   nothing to the scatter.
3. Transposed fit times fit is the scatter, its products spread over tasks along the rows; its
   eigenvectors are found on the driver, which holds dims x dims numbers (``MAX_DIMS`` bounds it).
4. Rows times the whitening matrix are the projections.  Those of the fit list give the
   covariance that ``identity_error`` reports, measured and not assumed.

Blocks are read by several jobs and kept meanwhile (memory, then disk; lost ones are made again); Spark
lets go of them when the matrices are out of use.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, quoted, read_table, register

#: Dimensions beyond which the scatter is no matrix for the driver (128 MB there).
MAX_DIMS = 4096
ROWS_PER_BLOCK = 1024
#: MLlib lists the blocks of a product on the driver; beyond this many, blocks have more rows.
MAX_BLOCKS = 1 << 18
#: Bytes of rows that one task of a scatter holds.
SCATTER_BYTES = 64 << 20
#: Eigenvalues up to this share of the largest are rounding: their components vanish.
VANISHING = 1e-12
#: Entries beyond this are not represented as scaled whole numbers.
_LARGEST = float(1 << 61)


def whole_numbers(df: DataFrame, id_col: str, vec_col: str, scale: int = 64, offset: int = 1_000_000) -> tuple[DataFrame, int]:
    """(vec_id, x) of the usable rows, x = floor(scale * entry) + offset as the bytes of longs; and their length.

    Left out: null vectors, vectors that hold a null or non-finite entry or one too large to scale
    (2^61), empty ones, and those of another length than most (of equally frequent: the smallest).
    """
    v = F.col("v")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_LARGEST / scale))
    rows = df.select(quoted(id_col).alias("vec_id"), quoted(vec_col).cast("array<double>").alias("v")).filter(v.isNotNull() & (F.size("v") > 0) & F.forall("v", fine))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = common[0]["n"] if common else 0
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries; at most {MAX_DIMS}")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)).astype(np.int64) + offset
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "x"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return rows.filter(F.size("v") == dims).mapInArrow(pack, f"vec_id {id_type}, x binary"), dims


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with gapless numbers from 0 in column ``name``: places within written parts plus the parts' offsets."""
    held = materialise(df.withColumn("_at", F.monotonically_increasing_id()), "whitening-rows")
    part = F.shiftright("_at", 33).alias("_part")
    before = F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))  # one row for each written part
    parts = held.groupBy(part).count().select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return held.withColumn("_part", part).join(parts, "_part").select(*[quoted(c) for c in df.columns], (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(name))


def _longs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), -1)


def exact_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows of ``fit`` (x) and the sum of each dimension, in whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = _longs(batch.column(0))
            rows, high, low = rows + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(np.full(dims, rows), pa.int64()), pa.array(high), pa.array(low)], names=["d", "n", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(19,0)")).alias(c)
    sums = fit.select("x").mapInArrow(run, "d int, n long, high long, low long").groupBy("d").agg(wide("n"), wide("high"), wide("low")).orderBy("d").collect()
    return int(sums[0]["n"]), [(int(s["high"]) << 32) + int(s["low"]) for s in sums]


def centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """rows (row, x, ...) -> ..., row, c (x minus the mean, doubles), deviation (sum of (n*x - sum)^2, exact)."""
    whole, rest = np.array([s // n for s in sums]), np.array([s % n for s in sums])
    others = [c for c in rows.columns if c not in ("row", "x")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _longs(batch.column(1)) - whole
            if (n * (int(np.abs(y).max(initial=0)) + 1)) ** 2 * len(sums) < 1 << 63:
                deviation = ((n * y - rest) ** 2).sum(axis=1).tolist()
            else:
                deviation = [sum((n * a - b) ** 2 for a, b in zip(r, rest.tolist(), strict=True)) for r in y.tolist()]
            deviation = [Decimal(d) if d < 10**38 else None for d in deviation]
            c = y - rest / n
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], batch.column(0), pa.array(list(c), pa.list_(pa.float64())), pa.array(deviation, pa.decimal128(38, 0))], names=[*others, "row", "c", "deviation"])

    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in others)
    return rows.select("row", "x", *others).mapInArrow(run, f"{kinds}row long, c array<double>, deviation decimal(38,0)")


def block_matrix(rows: DataFrame, count: int, dims: int) -> BlockMatrix:
    """rows (row, c) as distributed blocks; rows that are missing are zero."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("row", array_to_vector("c").alias("c")), "c")
    per = max(ROWS_PER_BLOCK, -(-count // MAX_BLOCKS))
    return IndexedRowMatrix(vectors, count, dims).toBlockMatrix(per, dims)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transposed ``matrix`` times ``matrix``: blocks are multiplied in tasks of SCATTER_BYTES and added up."""
    held = max(1, SCATTER_BYTES // (8 * matrix.rowsPerBlock * matrix.numCols()))
    spread = -(-matrix.numRowBlocks // held)
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, spread)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues of ``v``, falling, up to ``components``; the columns that project and scale; which vanish (columns of zeros).

    The largest entry of every eigenvector is positive.
    """
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    vanish = values <= max(values[0], 0) * VANISHING
    return np.maximum(values, 0), np.where(vanish, 0.0, vectors / np.sqrt(np.where(vanish, 1.0, values))), vanish


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 16) -> DataFrame:
    """One row per usable row: vec_id, n, deviation, whitened, explained (arrays, one entry a component), identity_error.

    Rows that :func:`whole_numbers` leaves out are not returned.  Every distinct vector counts once in
    the fit; repeated rows and ids each get their row, a null id is passed on.  A component whose
    eigenvalue vanishes (fewer distinct vectors than dimensions, one vector only) has a null
    ``whitened`` entry and does not count in ``identity_error``; ``explained`` is null if the
    covariance is zero.  A deviation of 10^38 or more is null.  Equal eigenvalues: any order.  An empty
    table gives no rows.  Other columns are not read.
    """
    usable, dims = whole_numbers(df, id_col, vec_col)
    empty = usable.select("vec_id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"),
                          F.lit(None).cast("array<double>").alias("explained"), F.lit(0.0).alias("identity_error"))
    if not dims:
        return empty.filter(F.lit(False))
    rows = materialise(numbered(usable, "row"), "whitening-numbered")
    fit = materialise(rows.groupBy("x").agg(F.min("row").alias("row")), "whitening-fit")
    count = rows.count()
    n, sums = exact_sums(fit, dims)
    held = block_matrix(centred(fit, n, sums), count, dims).persist(StorageLevel.MEMORY_AND_DISK)
    covariance = scatter(held) / n
    values, projection, vanish = whitening_matrix(covariance, components)
    width = projection.shape[1]
    block = DenseMatrix(dims, width, projection.ravel(order="F").tolist())
    whitener = BlockMatrix(df.sparkSession.sparkContext.parallelize([((0, 0), block)], 1), dims, width, dims, width)
    turned = held.multiply(whitener).persist(StorageLevel.MEMORY_AND_DISK)
    found = scatter(turned) / n
    there = np.flatnonzero(~vanish)
    error = float(np.abs(found[np.ix_(there, there)] - np.eye(len(there))).max(initial=0))
    trace = float(np.trace(covariance))
    whole = centred(rows, n, sums)
    blocks = block_matrix(whole, count, dims).persist(StorageLevel.MEMORY_AND_DISK)  # listed, then multiplied
    projected = blocks.multiply(whitener).toIndexedRowMatrix()
    vectors = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model).toDF("row", "w")
    masked = F.transform(vector_to_array("w"), lambda w, i: F.when(F.get(F.lit(vanish.tolist()), i), F.lit(None)).otherwise(w))
    explained = F.lit((values / trace).tolist()) if trace > 0 else F.lit(None).cast("array<double>")
    return whole.select("row", "vec_id", "deviation").join(vectors.select("row", masked.alias("whitened")), "row") \
        .select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


@register("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(read_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS long)"))
    return found.select("vec_id", F.posexplode("whitened").alias("at", "whitened"), "n", "deviation", "explained", "identity_error") \
        .select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("at")).alias("explained"), "identity_error")
