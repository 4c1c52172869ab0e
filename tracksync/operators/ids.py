"""Surrogate ids for appended rows (a sequence: unique, increasing, gaps allowed).

Spark has no distributed dense index in the DataFrame API apart from a global
window, which would pull every row into one task.  Instead: count rows per
input partition, turn the counts into offsets (a window over one row per partition),
join them back and add the position inside the partition.  The
input is checkpointed first so that both passes see the same partitions and a
recomputation after a lost executor cannot hand out different ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..session import ensure_checkpoint_dir


def dense_index(df: DataFrame, col: str = "row_index", start: int = 0,
                checkpoint: bool = True) -> tuple[DataFrame, int]:
    """``df`` with ``col`` = start, start+1, ... and the number of rows.

    Row order follows the partition order of ``df`` (so a sorted input gives ids
    in sort order).
    """
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    marked = df.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    # one row per partition
    parts = marked.groupBy("_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    total = df.count()
    index = (F.lit(start) + F.col("_before") + F.col("_id") - F.col("_first")).cast("long").alias(col)
    return marked.join(parts, "_part").select(*[exact(c) for c in df.columns if c != col], index), total


def with_dense_index(df: DataFrame, col: str = "row_index", start: int = 0, checkpoint: bool = True) -> DataFrame:
    return dense_index(df, col, start, checkpoint)[0]


class IdSequence:
    """Next free id of a table, kept on the driver across appends of one run.

    One aggregate at the start (``from_table``); every append advances the
    sequence by the number of rows it assigned, so later appends do not rescan
    the (large) table for its maximum.
    """

    def __init__(self, next_id: int):
        self.next_id = next_id

    @classmethod
    def from_table(cls, df: DataFrame, col: str = "id") -> IdSequence:
        return cls(int(df.agg(F.coalesce(F.max(col), F.lit(0))).first()[0]) + 1)

    def assign(self, df: DataFrame, col: str = "id") -> DataFrame:
        out, n = dense_index(df, col, self.next_id)
        self.next_id += n
        return out
