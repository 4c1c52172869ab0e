"""API items saved as a table of one variant column, shredded by Parquet.

Every member that occurs with one type becomes a column of its own in the file, so a filter and a
projection over some members read those and no others; a member of mixed types keeps its exact
values in its own binary column.  ``operators.export`` takes such a table as it takes parsed pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, VariantType

ITEM_COL = "item"
#: Settings that make a written variant a set of typed columns.
SHREDDING = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")


def as_variant(items: DataFrame, item_col: str = ITEM_COL) -> DataFrame:
    """The item column (JSON text, ``map<string,variant>`` or variant) as a variant; broken text fails the job."""
    kind = items.schema[item_col].dataType
    if isinstance(kind, VariantType):
        return items
    if isinstance(kind, StringType):
        return items.withColumn(item_col, F.parse_json(F.col(item_col)))
    if isinstance(kind, MapType):
        return items.withColumn(item_col, F.to_variant_object(F.col(item_col)))
    raise TypeError(f"items are JSON text, a map of variants or a variant, not {kind.simpleString()}")


def save_items(items: DataFrame, path: str, item_col: str = ITEM_COL, mode: str = "errorifexists") -> str:
    """Write ``items`` to ``path`` with their members shredded; other columns are kept.  Returns ``path``."""
    conf = items.sparkSession.conf
    before = {key: conf.get(key) for key in SHREDDING}
    for key in SHREDDING:
        conf.set(key, "true")
    try:
        as_variant(items, item_col).write.mode(mode).parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)
    return path


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items saved by :func:`save_items`."""
    return spark.read.parquet(path)
