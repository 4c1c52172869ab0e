"""Tracked items: seeding from the registry with constant columns and fresh ids."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..functions import run_timestamp, starts_with
from .ids import IdSequence

ITEM_COLUMNS = ["id", "type_id", "project_id", "subject", "description", "status_id", "priority_id", "author_id",
                "lock_version", "created_at", "updated_at", "schedule_manually", "ignore_non_working_days"]


def seed_rows(registry: DataFrame, items: DataFrame, cfg: SyncConfig,
              run_ts: _dt.datetime | None = None) -> DataFrame:
    """O-05, O-53, O-04, O-52: one new item per registry number missing as a subject (bag:
    a repeated number gives repeated rows), numbers with the excluded prefix skipped.
    Every row carries the same run timestamp.  Output has no id (see :func:`append_items`)."""
    s = cfg.seed
    src = registry.select(F.col("num").cast("string").alias("subject"))
    if cfg.seed_exclude_prefix is not None:
        src = src.filter(~starts_with("subject", cfg.seed_exclude_prefix))
    new = src.join(items.select("subject"), "subject", "left_anti")
    ts = run_timestamp(run_ts)
    return new.select(
        F.lit(s.type_id).alias("type_id"), F.lit(s.project_id).alias("project_id"), "subject",
        F.lit(s.description).alias("description"), F.lit(s.status_id).alias("status_id"),
        F.lit(s.priority_id).alias("priority_id"), F.lit(s.author_id).alias("author_id"),
        F.lit(s.lock_version).alias("lock_version"), ts.alias("created_at"), ts.alias("updated_at"),
        F.lit(s.schedule_manually).alias("schedule_manually"),
        F.lit(s.ignore_non_working_days).alias("ignore_non_working_days"))


def append_items(items: DataFrame, new_rows: DataFrame, seq: IdSequence | None = None) -> DataFrame:
    """O-11: new ids above ``max(items.id)``, dense in subject order, then union by name.

    The sort is a range-partitioned distributed sort (no single task); the ids
    follow partition order.  Items may carry fewer columns than a full item row;
    missing ones become NULL.
    """
    seq = seq or IdSequence.from_table(items, "id")
    ided = seq.assign(new_rows.orderBy("subject"), "id")
    return items.unionByName(ided.select(*[c for c in items.columns if c in ided.columns]),
                             allowMissingColumns=True)
