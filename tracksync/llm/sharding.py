"""Sharding by sampled splitters.

1. Key samples are drawn with a chance in proportion to record size; their quantiles are the
   splitters of the key ranges.  Null keys are a range of their own, before all others.
2. Records are range-partitioned by the splitters (binary search in a literal array).  The
   exact rows and bytes of every range are counted, and overfull ranges are subdivided at
   quantiles of their own samples until none is left; a key that fills quantiles gets a range of
   its own, and a range of one key is cut at quantiles of its rows.  Quantiles are places in sorted
   samples, exact for any long, and every subdivision also cuts before the range's largest value, so
   each round parts every overfull range.
3. The ranges' running byte totals place every record on one line of bytes; shard ``s`` is the
   records whose middle lies in the ``s``-th of ``shards`` equal parts of that line, so shards
   are key ranges and differ by at most the size of one record.

The text itself is read once; everything after works on (key, size, checksum) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, quoted, read_table, register

#: Size-weighted samples for each range.
SAMPLES_PER_RANGE = 20
#: Samples drawn in an overfull range, and the parts they cut it into.
CUT_SAMPLE = 1280
CUT_PARTS = 64
#: Ranges at the start: the splitters are literals in the plan.  At most as many ranges are ever
#: overfull by rows, and as many by bytes, so all their cuts stay below 2 x 130 x MAX_RANGES longs.
MAX_RANGES = 4096
#: A range with more than this many times the mean of bytes or of rows is overfull.
OVERFULL = 2


def _range_of(key, bounds: list[int]):
    """Number of bounds that are <= key: a binary search over the sorted literal array."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(int(b)) for b in bounds])
    step = lambda s, _: F.when(s["lo"] >= s["hi"], s).otherwise(
        F.when(F.get(array, F.floor((s["lo"] + s["hi"]) / 2).cast("int")) <= key,
               F.struct((F.floor((s["lo"] + s["hi"]) / 2) + 1).cast("int").alias("lo"), s["hi"].alias("hi")))
        .otherwise(F.struct(s["lo"].alias("lo"), F.floor((s["lo"] + s["hi"]) / 2).cast("int").alias("hi"))))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(bounds).bit_length())), start, step, lambda s: s["lo"])


def _drawn(chance, seed: int):
    return F.pmod(F.xxhash64("_key", "_row", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < chance


def splitters(keyed: DataFrame, ranges: int, total: int) -> list[int]:
    """Quantiles of size-weighted key samples: at most 2 x ``ranges`` bounds.

    A key that fills more than one quantile is heavy; it gets a range of its own.  About
    SAMPLES_PER_RANGE x ``ranges`` keys reach the driver.
    """
    wanted = ranges * SAMPLES_PER_RANGE
    sample = sorted(r[0] for r in keyed.filter(F.col("_key").isNotNull() & _drawn(F.col("_size") * F.lit(wanted / max(total, 1)), 17)).select("_key").collect())
    found = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []
    heavy = {a for a, b in zip(found, found[1:], strict=False) if a == b}
    return sorted({*found, *(k + 1 for k in heavy if k + 1 < 1 << 63)})


def _cuts(placed: DataFrame, over: DataFrame, value, seed: int) -> DataFrame:
    """(_range, _least, _most, _cuts): where to cut the ranges ``over``, sorted."""
    chance = F.lit(float(CUT_SAMPLE)) * F.greatest(F.col("_size") / F.col("_bytes"), F.lit(1.0) / F.col("_n"))
    samples = placed.join(F.broadcast(over), "_range").filter(_drawn(chance, seed)).groupBy("_range").agg(F.sort_array(F.collect_list(value)).alias("_s"))
    last = F.when(F.col("_least").eqNullSafe(F.col("_most")), F.col("_last_row")).otherwise(F.col("_most"))
    points = F.transform(F.sequence(F.lit(1), F.lit(CUT_PARTS - 1)), lambda i: F.get("_s", F.floor(i * F.size("_s") / F.lit(CUT_PARTS)).cast("int")))
    points = F.filter(F.when(F.col("_s").isNull(), F.array().cast("array<long>")).otherwise(points), lambda c: c.isNotNull())
    cuts = over.join(samples, "_range", "left").withColumn("_q", points)
    heavy = F.filter("_q", lambda c, i: (i > 0) & (c == F.get("_q", i - 1)) & (c < F.lit((1 << 63) - 1)))
    return cuts.select("_range", "_least", "_most", F.array_sort(F.array_distinct(F.concat("_q", F.transform(heavy, lambda c: c + 1), F.array(last)))).alias("_cuts"))


def assign_shards(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 8, carry: list[str] | None = None) -> DataFrame:
    """One row per record: ``carry`` columns in struct ``_row_cols``, size, text_crc32, shard, slot.

    ``key`` is a long of any value; null keys go first.  Size is the text's UTF-8 bytes (null: none) plus
    ``overhead``.  Slots count a shard's records from 0 in key order; equal keys keep scan
    order.  An empty table gives no rows.  Extra columns are carried only if named.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    keyed = df.select(
        F.struct(*[quoted(c) for c in ([key] if carry is None else carry)]).alias("_row_cols"),
        quoted(key).cast("long").alias("_key"),
        (F.coalesce(F.octet_length(quoted(text)), F.lit(0)) + F.lit(overhead)).cast("long").alias("_size"),
        F.coalesce(F.crc32(quoted(text)), F.lit(0)).cast("long").alias("_crc"),
        F.monotonically_increasing_id().alias("_row"))
    keyed = materialise(keyed, "shard-keys")
    rows, total = keyed.agg(F.count(F.lit(1)), F.sum("_size")).first()
    total = total or 0
    ranges = max(8 * shards, min(-(-rows // 1_000_000), MAX_RANGES))
    bounds = splitters(keyed, ranges, total)
    first = F.when(F.col("_key").isNull(), F.lit(0)).otherwise(_range_of(F.col("_key"), bounds) + 1)
    placed = materialise(keyed.withColumn("_range", F.struct(first.cast("long").alias("r0"))), "shard-placed")

    count = lambda d: materialise(d.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_bytes"), F.min("_key").alias("_least"), F.max("_key").alias("_most"), F.max("_row").alias("_last_row")), "shard-ranges")
    totals = count(placed)
    depth = 0
    while True:
        limit_n, limit_b = OVERFULL * max(1, rows / ranges), OVERFULL * max(1, total / ranges)
        # a long record alone in a range is not overfull: it cannot be cut
        over = totals.filter((F.col("_n") > 1) & ((F.col("_n") > limit_n) | (F.col("_bytes") > limit_b)))
        if over.isEmpty():
            break
        depth += 1
        name = f"r{depth}"
        # one repeated key (or none): at quantiles of its rows; several keys: at their own
        value = F.when(F.col("_least").eqNullSafe(F.col("_most")), F.col("_row")).otherwise(F.col("_key"))
        cuts = materialise(_cuts(placed, over, value, 30 + depth), "shard-cuts")
        # bounds <= value counted
        sub = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(F.size(F.filter("_cuts", lambda c: c <= value))).cast("long")
        old = [f"r{i}" for i in range(depth)]
        placed = materialise(placed.join(F.broadcast(cuts), "_range", "left").withColumn(
            "_range", F.struct(*[F.col(f"_range.{c}").alias(c) for c in old], sub.alias(name))).drop("_cuts", "_least", "_most"), "shard-placed")
        totals = count(placed)
    line = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("_range", F.coalesce(F.sum("_bytes").over(line), F.lit(0)).alias("_bytes_before"), F.coalesce(F.sum("_n").over(line), F.lit(0)).alias("_rows_before"))
    own = W.partitionBy("_range").orderBy("_key", "_row")
    at = placed.withColumn("_k", F.row_number().over(own) - 1).withColumn("_b", F.sum("_size").over(own.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_size"))
    at = at.join(before, "_range")
    middle = F.col("_bytes_before") + F.col("_b") + F.col("_size") / F.lit(2)
    at = at.withColumn("shard", F.least(F.floor(middle * F.lit(shards) / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int")) \
        .withColumn("_place", F.col("_rows_before") + F.col("_k"))
    at = materialise(at.select("_row_cols", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard", "_place"), "shard-rows")
    firsts = at.groupBy("shard").agg(F.min("_place").alias("_first"))  # one row per shard
    return at.join(F.broadcast(firsts), "shard").select("_row_cols", "size", "text_crc32", "shard", (F.col("_place") - F.col("_first")).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, key: str = "doc_id", text: str = "text") -> None:
    """Write all records below ``path/shard=N``, within each file in slot order."""
    placed = assign_shards(df, shards, key, text, carry=df.columns)
    out = placed.select("shard", "slot", *[F.col("_row_cols").getField(c).alias(c) for c in df.columns if c not in ("shard", "slot")])
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


@register("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign_shards(read_table(spark, sf_dir, "documents"), 24)
    return placed.select("_row_cols.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
