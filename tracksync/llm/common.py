"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracksync.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let the Python workers find this package where the driver has it, whatever its working folder."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def register(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage on storage every executor can reach, so a lost executor costs a
    re-read and not a re-computation.
    """
    return _written(df, name, None)


def materialise_texts(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialise` for rows with whole texts, packed more tightly (zstd)."""
    return _written(df, name, "zstd")


def _written(df: DataFrame, name: str, compression: str | None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Add a unique long per row (scan order); materialise before relying on it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def quoted(name: str):
    """The column of this exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Texts may be long: rows of one Arrow batch between Spark and a Python worker.
ROWS_PER_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Have the session send at most ROWS_PER_BATCH rows to a Python worker at once (it may be set lower)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))


def filter_rows(df: DataFrame, column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``df`` for whose values of ``column`` ``keep`` says True; any column names, one narrow pass.

    Only ``column`` goes to the Python workers, and one flag comes back.
    """
    small_batches(df.sparkSession)

    @F.arrow_udf("boolean")
    def kept(values: pa.Array) -> pa.Array:
        return pa.array(keep(values.to_pylist()), pa.bool_())

    return df.filter(kept(quoted(column)))


_HELD: dict = {}


def held_by_worker(name: str, key: int, make: Callable):
    """What ``make`` gives, kept by this Python worker for its next tasks of the same operator.

    A worker keeps one such thing: what another operator left goes first, so the memory of a
    pipeline's worker is that of its present stage.
    """
    if (name, key) not in _HELD:
        _HELD.clear()
        pa.default_memory_pool().release_unused()
        _HELD[name, key] = make()
    return _HELD[name, key]
