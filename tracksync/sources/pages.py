"""Saved API pages read with the paging client's stopping rules.

Envelope (one JSON document per page): ``{"offset": n, "pageSize": s,
"_embedded": {"elements": [ {...}, ... ]}}``; one page per line (JSON Lines, many pages per
file), or with ``multi_line=True`` one document per file.

Reading keeps what the sequential client keeps: pages 1, 2, ... up to and including the
first short page (fewer than ``page_size`` elements), stopping before the first malformed
page, the first page without ``_embedded.elements`` and the first missing page number.  The
cut-offs are three minima over a table with one row per page; only those three numbers reach
the driver.  A page without ``offset``, a malformed one above all, takes its number from the
first digits of its file's name where a file is one page, else from the place of its line:
lines of earlier files (by name) and earlier lines, plus one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE_SCHEMA = "offset long, pageSize long, _embedded struct<elements: array<map<string,variant>>>, _corrupt_record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, place) of every line that is not blank; places count from 1 over all files."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    raw = raw.filter(F.trim("value") != "").withColumn("_id", F.monotonically_increasing_id())
    # one row per file block: ids run on without a gap inside a block
    blocks = raw.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("_file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return raw.join(blocks, ["_file", "_block"]).select("value", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("place"))


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """(value, place) of every file; the place is the first number in its name."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1)
    return spark.read.text(path, wholetext=True).select("value", F.when(name != "", name.cast("long")).alias("place"))


def read_pages(spark: SparkSession, path: str, page_size: int = 1000, multi_line: bool = False) -> DataFrame:
    """(page, pos, item map<string,variant>) for every element the paging client would keep."""
    return items_of_pages(_documents(spark, path) if multi_line else _lines(spark, path), page_size)


def items_of_pages(source: DataFrame, page_size: int = 1000) -> DataFrame:
    """The same for pages that are rows already: ``source`` has (value, place), one document a row."""
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    raw = source.select("place", F.from_json("value", PAGE_SCHEMA, how).alias("p"))
    page_no = F.coalesce(F.col("p.offset"), F.col("place"))
    els = F.col("p._embedded.elements")
    bad = F.col("p").isNull() | F.col("p._corrupt_record").isNotNull() | els.isNull()
    # one row per page, parsed once and kept for the three cut-off aggregates
    pages = raw.select(page_no.alias("page"), bad.alias("bad"), F.coalesce(F.size(els), F.lit(0)).alias("n")).persist()
    cuts = pages.filter(F.col("page").isNotNull()).agg(
        F.min(F.when(F.col("bad"), F.col("page"))).alias("first_bad"),
        F.min(F.when(~F.col("bad") & (F.col("n") < page_size), F.col("page"))).alias("first_short"),
    ).first()
    present = pages.filter(F.col("page").isNotNull()).select("page").distinct()
    nxt = present.select((F.col("page") + 1).alias("page"))
    gaps = nxt.join(present, "page", "left_anti").agg(F.min("page")).first()[0]
    has_first = present.filter(F.col("page") == 1).limit(1).count() == 1
    first_missing = 1 if not has_first else gaps
    pages.unpersist()
    keep = F.col("page") >= 1
    if cuts["first_bad"] is not None:
        keep &= F.col("page") < F.lit(cuts["first_bad"])
    if cuts["first_short"] is not None:
        keep &= F.col("page") <= F.lit(cuts["first_short"])
    if first_missing is not None:
        keep &= F.col("page") < F.lit(first_missing)
    good = raw.filter(~bad).select(page_no.alias("page"), els.alias("e"))
    return good.filter(keep).select("page", F.posexplode("e").alias("pos", "item"))
