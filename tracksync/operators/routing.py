"""Item routing: project assignment from a field value, parent re-routing, field filling.

Items: (id, type_id, subject, project_id, ...); projects: (id, name, parent_id), a
small dimension.  Updates with several candidate
projects take the smallest project id (deterministic form of an arbitrary pick).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..functions import strip_word, with_suffix
from . import eav


def update_items(items: DataFrame, source: DataFrame, *, set_col: str, where: Column | None = None,
                 flag_col: str | None = None) -> DataFrame:
    """``UPDATE items SET set_col = s.new FROM source s WHERE items.id = s.id [AND where]``.

    ``source`` is (id, new); reduced to one row per id (min) before the join.
    """
    red = source.groupBy("id").agg(F.min("new").alias("_new"), F.max(F.lit(True)).alias("_hit"))
    j = items.join(red, "id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    cols = [F.when(hit, F.col("_new")).otherwise(F.col(c)).alias(c) if c == set_col else F.col(c) for c in items.columns]
    if flag_col:
        cols.append(hit.alias(flag_col))
    return j.select(*cols)


def field_values_by_label(values: DataFrame, fields: DataFrame, label: str) -> DataFrame:
    """EAV rows of the field(s) named ``label`` (no entity-type guard)."""
    f = fields.filter(F.col("name") == F.lit(label)).select(F.col("id").alias("custom_field_id"))
    return values.join(f, "custom_field_id", "left_semi")


def route_by_value(items: DataFrame, values: DataFrame, fields: DataFrame, projects: DataFrame,
                   cfg: SyncConfig, *, item_type: int | None = None, suffix: str | None = None,
                   flag_col: str | None = None) -> DataFrame:
    """O-60 / O-61 / O-32: set ``project_id`` of items of ``item_type`` to the project whose
    name equals the partner value (``value || suffix`` when a suffix is given)."""
    item_type = cfg.dossier_type if item_type is None else item_type
    v = field_values_by_label(values, fields, cfg.partner_label)
    key = F.col("value") if suffix is None else with_suffix("value", suffix)
    # '' names no project: it must not meet the join as one hot key
    v = v.filter(F.col("value") != F.lit("")) if suffix is None else v
    v = v.select(F.col("customized_id").alias("id"), key.alias("pname"))
    p = projects.select(F.col("id").alias("new"), F.col("name").alias("pname"))
    src = v.join(p, "pname").select("id", "new")
    return update_items(items, src, set_col="project_id", where=F.col("type_id") == F.lit(item_type),
                        flag_col=flag_col)


def reroute_to_parent(items: DataFrame, values: DataFrame, relations: DataFrame, projects: DataFrame,
                      cfg: SyncConfig, flag_col: str | None = None) -> DataFrame:
    """O-67: a dossier linked from a request (reference value + relation request -> dossier)
    moves to the parent project of the request's project.

    The relation is joined first: the reference value then only confirms a known target, in a join on
    (target, value), so a value on many requests is no join key of its own.
    """
    req = items.filter(F.col("type_id") == F.lit(cfg.request_type)).select(
        F.col("id").alias("req_id"), F.col("project_id").alias("req_project"))
    ref = values.filter((F.col("customized_type") == F.lit(cfg.entity_type))
                        & (F.col("custom_field_id") == F.lit(cfg.ref_field_id))
                        & F.col("value").isNotNull()).select(F.col("customized_id").alias("req_id"), "value")
    tgt = items.filter(F.col("type_id") == F.lit(cfg.dossier_type)).select(
        F.col("id").alias("target_id"), F.col("subject").alias("value"))
    rel = relations.select(F.col("from_id").alias("req_id"), F.col("to_id").alias("target_id"))
    p = projects.select(F.col("id").alias("req_project"), "parent_id")
    parent = projects.select(F.col("id").alias("parent_id"))
    src = (req.join(ref, "req_id").join(rel, "req_id").join(tgt, ["target_id", "value"])
           .join(p, "req_project").join(parent, "parent_id")
           .select(F.col("target_id").alias("id"), F.col("parent_id").alias("new")))
    return update_items(items, src, set_col="project_id", flag_col=flag_col)


def fill_from_project(values: DataFrame, items: DataFrame, projects: DataFrame, cfg: SyncConfig, *,
                      item_type: int | None = None, flag_col: str | None = None) -> DataFrame:
    """O-65, O-49: an empty partner value (NULL or '') of an item of ``item_type`` takes the
    item's project name without the suffix word (case-insensitive, with its blanks)."""
    item_type = cfg.dossier_type if item_type is None else item_type
    p = projects.select(F.col("id").alias("project_id"), "name")
    src = (items.filter(F.col("type_id") == F.lit(item_type)).select(F.col("id").alias("customized_id"), "project_id")
           .join(p, "project_id")
           .select("customized_id", F.lit(cfg.partner_field_id).alias("custom_field_id"),
                   strip_word("name", cfg.suffix_word).alias("new_value")))
    empty = F.col("value").isNull() | (F.col("value") == F.lit(""))
    return eav.apply_update(values, src, entity_type=cfg.entity_type, where=empty, flag_col=flag_col,
                            field_ids=[cfg.partner_field_id])
