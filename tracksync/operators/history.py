"""State histories: JSON array per dossier -> one row per entry -> latest per state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..functions import format_day, parse_history, starts_with


def history_entries(items: DataFrame, history: DataFrame, cfg: SyncConfig) -> DataFrame:
    """(item_id, state, state_ts) for every entry of every matched history.

    ``history`` is (num, hist JSON text).  Items match on ``subject = num``; a NULL
    or empty history yields no rows (inner explode, as the lateral join does).
    The date text is cast with ANSI rules, so a malformed date fails the job.
    Histories are bounded per dossier, so the explode is bounded per row.
    """
    h = (history.filter(starts_with("num", cfg.history_prefix))
         .select("num", parse_history("hist", cfg.history_state_key, cfg.history_date_key,
                                      cfg.strict_json).alias("h")))
    joined = items.select(F.col("id").alias("item_id"), F.col("subject").alias("num")).join(h, "num")
    # posexplode_outer + "pos is not null" = explode (NULL / empty arrays vanish, NULL
    # elements stay), but the optimizer infers no size(h) > 0 filter from it, which it
    # would push below the projection and so parse the JSON three times per row.
    e = joined.select("item_id", F.posexplode_outer("h").alias("pos", "e")).filter(F.col("pos").isNotNull())
    return e.select(
        "item_id",
        F.col("e")[cfg.history_state_key].alias("state"),
        F.col("e")[cfg.history_date_key].cast("timestamp_ntz").alias("state_ts"),
    )


def latest_per_state(entries: DataFrame) -> DataFrame:
    """(item_id, state, state_date 'yyyy-MM-dd') of the latest entry per (item, state).

    "Latest" orders dates descending with NULLs first, so a NULL date wins.  The
    winning row's only payload is the ordering value itself, so this is an
    aggregate (partial, map-side) rather than a window: a dossier with a huge
    history never lands whole in one task.
    """
    any_null = F.max(F.col("state_ts").isNull())
    latest = F.when(any_null, F.lit(None)).otherwise(F.max("state_ts"))
    return entries.groupBy("item_id", "state").agg(format_day(latest).alias("state_date"))


def history_datos(entries: DataFrame, latest: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(insert source, update source) for the EAV upsert, as (item_id, attr, value).

    The update source is an aggregate of the insert source, so its labels are a
    subset: the insert source alone determines the fields the upsert touches.
    """
    ins = entries.select("item_id", F.col("state").alias("attr"), F.lit(None).cast("string").alias("value"))
    lat = latest if latest is not None else latest_per_state(entries)
    upd = lat.select("item_id", F.col("state").alias("attr"), F.col("state_date").alias("value"))
    return ins, upd
