"""Textbook forms of rewritten operators, for tests and measurements on small inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracksync.config import SyncConfig
from tracksync.functions import ElementClasses, format_day
from tracksync.operators.registry import active_registry


def capacity_naive(registry: DataFrame, element: DataFrame, conduct: DataFrame, cfg: SyncConfig) -> DataFrame:
    """The literal fan-out form of :func:`capacity` (test oracle on small inputs only)."""
    c = ElementClasses(cfg.vocab)
    reg = active_registry(registry, cfg).select("id", "num", "installed", "used")
    j = (reg.join(element.select("owner_id", "kind"), reg["id"] == element["owner_id"]).drop("owner_id")
         .join(conduct.select("owner_id", "length_dm"), reg["id"] == conduct["owner_id"]))
    g = j.groupBy("num", "installed", "used").agg(
        F.count("length_dm").alias("cable_count"), F.count_if(c.pole()).alias("_poles"))
    return g.select("num", "installed", "used", "cable_count",
                    F.when(F.col("_poles") > 0, F.lit(cfg.pole_yes)).otherwise(F.lit(cfg.pole_no)).alias("has_pole"))


def latest_per_state_window(entries: DataFrame) -> DataFrame:
    """Same result through ``row_number`` (the textbook form; used as a test oracle)."""
    w = Window.partitionBy("item_id", "state").orderBy(F.col("state_ts").desc_nulls_first())
    return (entries.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
            .select("item_id", "state", format_day("state_ts").alias("state_date")))
