"""Mixing sources to target weights by systematic sampling.

Targets: the sources, in code-point order (null last), take the weights in turn and share
``budget`` times all words; a target stops at ``cap`` times its source's words and the
excess is shared again by weight.  Every document of a source expects
``target / source words`` copies.  The documents of a source stand in one line, ordered by
size; the running sum of expected copies plus one seeded offset per source crosses integers,
and a document is emitted once for each integer crossed in its step.

The line is never one task: documents go to cells (source, size class, hash slice) of about
``cell_rows`` rows.  Cells are counted first, the cell counts give each cell its place in the
line, and the place within the cell is a window over that cell alone.  A cell that repeated
ids overfill is cut at them, and the rows of one id are dealt over cells by their content.
Neither the cells of a source nor the sources are one task either: they are range-partitioned, and
running sums go over ranges first (``running_sums``).

Words are counted once: sizes and hashes are written with the rows they belong to, under a number
of the row, and the steps that place rows read and shuffle the small columns alone.  Whole rows are
stored once and shuffled once, when they meet their copies by that number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialise, materialise_texts, quoted, read_table, register, with_row_id

SEED = "mix-1"
#: A cell of more than this many times ``cell_rows`` is looked through for repeated ids.
OVERFULL = 2


def _hex_fraction(col):
    """First 8 hex digits of an md5 as a number in [0, 1)."""
    return F.conv(F.substring(col, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def running_sums(df: DataFrame, by: list[str], order: list, sums: dict[str, str], name: str) -> DataFrame:
    """``df`` plus, for each {column: output}, its sum over the earlier rows of the same ``by`` in ``order`` (0 on the first).

    ``order`` must tell all rows of one ``by`` apart.  Rows are range-partitioned by (by, order) and written; a window
    over ranges (at most one row for each range and group) and one within each range add up, so no
    task holds a group.  Null ``by`` values are a group.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in by], *order).withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, name)
    earlier = (W.unboundedPreceding, -1)

    def shifted(window, columns: dict[str, str]) -> list:
        return [F.coalesce(F.sum(c).over(window), F.lit(0)).alias(out) for c, out in columns.items()]

    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(out) for c, out in sums.items()])
    over_ranges = W.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(*earlier)
    ahead = totals.select(*by, "_range", *shifted(over_ranges, {out: out for out in sums.values()}))
    within = W.partitionBy(*by, "_range").orderBy(*order).rowsBetween(*earlier)
    inner = ranged.select("*", *shifted(within, {c: out for c, out in sums.items()}))
    same = F.col("i._range") == F.col("a._range")
    for c in by:
        same = same & F.col(f"i.{c}").eqNullSafe(F.col(f"a.{c}"))
    return inner.alias("i").join(ahead.alias("a"), same) \
        .select(*[F.col(f"i.{c}") for c in df.columns], *[(F.col(f"i.{out}") + F.col(f"a.{out}")).alias(out) for out in sums.values()])


def source_targets(sizes: DataFrame, weights=(5, 2, 1), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size, n_docs, one row each) -> the same with target.

    Sources reach their cap in the order of cap / weight.  ``level`` is the share per weight
    if all sources before this one are full; the first source that is not full at its own
    level sets it for the rest, and levels do not rise from there on: it is the highest of an open source,
    also where several sources reach their cap at once.  Totals and that level are aggregates of one row.
    """
    by_name = [F.col("source").asc_nulls_last()]
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = running_sums(sizes.withColumn("_one", F.lit(1)), [], by_name, {"_one": "_rank"}, "mix-sources") \
        .withColumn("_w", F.element_at(table, (F.col("_rank") % len(weights) + 1).cast("int"))) \
        .withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    full_first = [F.col("_cap") / F.col("_w"), *by_name]
    filled = running_sums(ranked, [], full_first, {"_cap": "_full", "_w": "_w_full"}, "mix-fill")
    totals = ranked.groupBy("_one").agg(F.sum("source_size").alias("_words"), F.sum("_w").alias("_weights"))
    leveled = filled.join(F.broadcast(totals), "_one") \
        .withColumn("_level", (F.lit(float(budget)) * F.col("_words") - F.col("_full")) / (F.col("_weights") - F.col("_w_full")))
    is_open = F.col("_level") * F.col("_w") <= F.col("_cap")
    opened = leveled.groupBy("_one").agg(F.max(F.when(is_open, F.col("_level"))).alias("_open"))
    return leveled.join(F.broadcast(opened), "_one") \
        .withColumn("target", F.when(F.col("_open").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_open") * F.col("_w")))) \
        .select("source", "source_size", "n_docs", "target")


def _same_cell(a: str, b: str):
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")) & (F.col(f"{a}._class") == F.col(f"{b}._class")) & (F.col(f"{a}._slice") == F.col(f"{b}._slice"))


def _counted(placed: DataFrame) -> DataFrame:
    return materialise(placed.groupBy("source", "_class", "_slice").agg(F.count(F.lit(1)).alias("_n")), "mix-counts")


def _overfull(counts: DataFrame, cell_rows: int) -> DataFrame:
    return counts.filter(F.col("_n") > OVERFULL * cell_rows)


def _cut_at_repeated(placed: DataFrame, counts: DataFrame, cell_rows: int, key: list[str], spread: str) -> DataFrame:
    """Overfull cells are cut before and after each ``key`` of more than ``cell_rows`` rows; those rows are dealt by ``spread``.

    ``_slice`` gets two fields, so cells stay in the order of the keys.
    """
    over = F.broadcast(_overfull(counts, cell_rows))
    own = placed.alias("r").join(over.alias("o"), _same_cell("r", "o"), "left_semi")
    hot = own.groupBy("source", "_class", "_slice", F.struct(*key).alias("k")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_rows) \
        .groupBy("source", "_class", "_slice").agg(F.collect_list(F.struct("k", (F.floor((F.col("n") - 1) / cell_rows) + 1).alias("parts"))).alias("_hot"))
    hot = materialise(hot, "mix-repeated")
    fields = placed.schema["_slice"].dataType.names
    here = F.struct(*[F.col(f"r.{c}") for c in key])
    before = F.size(F.filter("_hot", lambda h: h["k"] < here))
    parts = F.get(F.filter("_hot", lambda h: h["k"] == here), F.lit(0))["parts"]
    cut = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(2 * before + parts.isNotNull().cast("int"))
    dealt = F.coalesce(F.pmod(F.xxhash64(F.col(f"r.{spread}")), parts), F.lit(0)).cast("long")
    slices = F.struct(*[F.col(f"r._slice.{f}").alias(f) for f in fields], cut.alias(f"s{len(fields)}"), dealt.alias(f"s{len(fields) + 1}"))
    return placed.alias("r").join(F.broadcast(hot).alias("o"), _same_cell("r", "o"), "left") \
        .select(*[F.col(f"r.{c}") for c in placed.columns if c != "_slice"], slices.alias("_slice"))


def mix_sources(docs: DataFrame, weights=(5, 2, 1), budget: float = 1.5, cap: float = 2.0, seed: str = SEED, cell_rows: int = 4096, carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``_row`` (its ``carry`` columns, default all), size, source_size, target, copies (int).

    Null text has size 0, null source is a source of its own.  A source without words gets
    target 0 and no copies.  Repeated rows each take a place of their own.  An empty table gives no rows.  Order within a
    source: size class, hash slice, size, md5(seed, doc_id), hash of the content: the same on
    every run but for rows that are equal in all of it.
    """
    kept = docs.columns if carry is None else carry
    base = docs.select(
        F.struct(*[quoted(c) for c in kept]).alias("_row"), F.col("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("_tie"),
        F.xxhash64("text", *[quoted(c) for c in kept if "map<" not in docs.schema[c].dataType.simpleString()]).alias("_check"))
    base = with_row_id(base.withColumn("_class", F.floor(F.sqrt(F.col("size").cast("double"))).cast("int")), "_id")
    stored = materialise_texts(base, "mix-sized")
    base = stored.drop("_row")
    cells = base.groupBy("source", "_class").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_words"))
    cells = materialise(cells, "mix-cells")
    sizes = cells.groupBy("source").agg(F.sum("_words").alias("source_size"), F.sum("_n").alias("n_docs"))
    targets = source_targets(sizes, weights, budget, cap)
    targets = targets.withColumn("_u", _hex_fraction(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("source"), F.lit("\x00null"))))))
    plan = cells.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))) \
        .select("c.source", "_class", (F.floor((F.col("_n") - 1) / cell_rows) + 1).cast("int").alias("_slices"), "source_size", "target", "_u")
    # size classes x sources rows: a dictionary, joined on both keys
    placed = base.alias("b").join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")) & (F.col("b._class") == F.col("p._class"))) \
        .select("b._id", "b.source", "b.size", "b._tie", "b._check", "b._class", "source_size", "target", "_u",
                F.struct(F.pmod(F.conv(F.substring("_tie", 9, 8), 16, 10).cast("long"), F.col("_slices")).cast("int").alias("s0")).alias("_slice"))
    cell = ["source", "_class", "_slice"]
    counts = _counted(placed)
    if not _overfull(counts, cell_rows).isEmpty():
        placed = materialise(placed, "mix-placed")
        for key, spread in ((["size", "_tie"], "_check"), (["_check"], "_id")):
            placed = _cut_at_repeated(placed, counts, cell_rows, key, spread)
            counts = _counted(placed)
    offsets = running_sums(counts, ["source"], [F.col("_class"), F.col("_slice")], {"_n": "_before"}, "mix-line")
    own = W.partitionBy(*cell).orderBy("size", "_tie", "_check")
    ranked = placed.withColumn("_k", F.row_number().over(own))
    k = F.col("_before") + F.col("_k")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(rate * k + F.col("_u")) - F.floor(rate * (k - 1) + F.col("_u"))
    mixed = ranked.alias("r").join(offsets.alias("o"), _same_cell("r", "o")).select("r._id", "r.size", "r.source_size", "r.target", crossed.cast("int").alias("copies"))
    return stored.select("_id", "_row").join(mixed, "_id").select("_row", "size", "source_size", "target", "copies")


def emit_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document once per copy, with the columns of the input."""
    return mixed.filter("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")) \
        .select(*[F.col("_row").getField(c).alias(c) for c in columns])


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS tie FROM documents),
sizes AS (SELECT source, sum(size) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM sizes),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         least(cap, coalesce((SELECT max(level) FROM levels WHERE level * w <= cap), 1e300) * w) AS target,
         CAST('0x' || substr(md5('mix-1|' || coalesce(source, chr(0) || 'null')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM levels),
classes AS (
  SELECT source, CAST(floor(sqrt(size)) AS INT) AS class, ((count(*) - 1) // 4096) + 1 AS slices FROM docs GROUP BY ALL),
line AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
         row_number() OVER (PARTITION BY d.source ORDER BY c.class, CAST('0x' || substr(d.tie, 9, 8) AS BIGINT) % c.slices, d.size, d.tie) AS k
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
  JOIN classes c ON d.source IS NOT DISTINCT FROM c.source AND c.class = CAST(floor(sqrt(d.size)) AS INT)),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM line)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((floor(rate * k + u) - floor(rate * (k - 1) + u)) * size AS BIGINT) AS taken FROM rated
"""


@register("op9_mixing", ORACLE)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("_row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
