"""Links between requests and dossiers, and fields every dossier must carry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from .skew import join_hot


def symmetric_anti_join(pairs: DataFrame, edges: DataFrame, a: str = "from_id", b: str = "to_id") -> DataFrame:
    """O-26: pairs with no edge in either orientation.

    ``(f=a AND t=b) OR (f=b AND t=a)`` is an OR of equalities, which Spark can only
    run as a nested-loop join; normalising both sides to (least, greatest) makes it
    one equi anti join (sort-merge or broadcast hash).
    """
    e = edges.select(F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi"))
    p = pairs.withColumn("_lo", F.least(a, b)).withColumn("_hi", F.greatest(a, b))
    return p.join(e, ["_lo", "_hi"], "left_anti").drop("_lo", "_hi")


def link_candidates(items: DataFrame, values: DataFrame, cfg: SyncConfig) -> DataFrame:
    """(from_id=request, to_id=dossier, relation_type) where the request's reference value
    names the dossier's subject (bag: every matching row pair).  Many requests may name one dossier."""
    req = items.filter(F.col("type_id") == F.lit(cfg.request_type)).select(F.col("id").alias("from_id"))
    ref = values.filter((F.col("customized_type") == F.lit(cfg.entity_type))
                        & (F.col("custom_field_id") == F.lit(cfg.ref_field_id))
                        & F.col("value").isNotNull()).select(F.col("customized_id").alias("from_id"), "value")
    dos = items.filter(F.col("type_id") == F.lit(cfg.dossier_type)).select(
        F.col("id").alias("to_id"), F.col("subject").alias("value"))
    return (join_hot(req.join(ref, "from_id"), dos, "value", among=ref)
            .select("from_id", "to_id", F.lit(cfg.relation_type).alias("relation_type")))


def link_items(items: DataFrame, values: DataFrame, relations: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-63: new relations = candidates not yet linked in either direction."""
    return symmetric_anti_join(link_candidates(items, values, cfg), relations)


def ensure_field(items: DataFrame, values: DataFrame, field_id: int, cfg: SyncConfig, *,
                 item_type: int | None = None) -> DataFrame:
    """O-07 / O-08 / O-64: one NULL row of ``field_id`` for each item of ``item_type`` lacking it.

    Written as an anti join; the LEFT JOIN ... IS NULL spelling is not rewritten
    to one by the optimizer.
    """
    item_type = cfg.dossier_type if item_type is None else item_type
    have = values.filter((F.col("customized_type") == F.lit(cfg.entity_type))
                         & (F.col("custom_field_id") == F.lit(field_id))).select(F.col("customized_id").alias("id"))
    need = items.filter(F.col("type_id") == F.lit(item_type)).select("id")
    return need.join(have, "id", "left_anti").select(
        F.lit(cfg.entity_type).alias("customized_type"), F.col("id").alias("customized_id"),
        F.lit(field_id).alias("custom_field_id"), F.lit(None).cast("string").alias("value"))
