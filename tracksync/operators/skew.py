"""Equi joins whose key may be one value on a large share of the rows.

A counting sketch over the key's hash finds the values that are frequent on the left; only
their rows are salted, so each meets the right side in ``salts`` tasks and not in one, while all other
rows join as they would have.  The sketch decides where a row is joined and never whether:
a value it misses or names in vain gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values the sketch follows at once; it finds each that is on more than a few of as many rows.
TRACKED = 10_000


def hot_hashes(df: DataFrame, key: str, share: float) -> DataFrame:
    """(_hash): hashes of the values on at least ``share`` of the rows with a key.  At most ``1 / share`` longs
    but for the sketch's error, ``2 / share`` by construction."""
    if not 0.0 < share <= 1.0:
        raise ValueError("share lies above 0 and at most at 1")
    most = min(int(2 / share), TRACKED)
    hashes = df.filter(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_hash"))
    found = hashes.agg(F.expr(f"approx_top_k(_hash, {most}, {TRACKED})").alias("_top"), F.count("_hash").alias("_rows"))
    return (found.select("_rows", F.inline("_top").alias("_hash", "_n"))
            .filter(F.col("_n") >= F.col("_rows") * F.lit(share)).select("_hash"))


def join_hot(left: DataFrame, right: DataFrame, key: str, *, among: DataFrame | None = None, share: float = 0.01,
             salts: int = 64) -> DataFrame:
    """Inner join on ``key``: the rows of ``left.join(right, key)``, repeated rows included.

    ``left`` is the side whose values may be hot: its hot rows are dealt by a hash of all their columns, so a
    recomputed task deals them alike.  Rows of ``right`` with a hot value are repeated ``salts`` times.
    NULL keys join nothing; an empty side gives no rows.  ``among`` is a cheaper frame with ``key`` to sketch
    where ``left`` is a join of its own.
    """
    hot = F.broadcast(hot_hashes(left if among is None else among, key, share).withColumn("_hot", F.lit(True)))  # at most 2 / share longs

    def marked(df: DataFrame, salt: Column) -> DataFrame:
        known = df.filter(F.col(key).isNotNull()).withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left")
        return known.withColumn("_salt", salt).drop("_hash", "_hot")

    dealt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(F.lit(0))
    every = F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    return marked(left, dealt.cast("int")).join(marked(right, every), [key, "_salt"]).drop("_salt")
