"""Catalog part 1: history sync and the EAV core (insert / update / upsert / resolve)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..config import SyncConfig
from ..operators import eav, history
from ..sources.fixtures import FIXTURE_CONFIG as CFG
from ..sources.fixtures import fixtures, oracle_ctes
from . import oracles
from .catalog import register

_HISTORY = ("fx_items", "fx_history")
_EAV = (*_HISTORY, "fx_fields", "fx_values")
_SOURCES = """wanted AS (SELECT item_id, state AS attr FROM entries),
given AS (SELECT item_id, state AS attr, state_date AS value FROM latest)"""


def _with_history(*more: str) -> str:
    return oracle_ctes(*_HISTORY, *more) + ", " + oracles.history("fx_items")


def _hist(spark, sf, cfg: SyncConfig = CFG):
    fx = fixtures(spark, sf, *_HISTORY)
    return history.history_entries(fx["fx_items"], fx["fx_history"], cfg)


@register("q_history_explode", _with_history() + "\nSELECT item_id, state, state_ts FROM entries")
def q_history_explode(spark, sf):
    """O-29, O-44, O-21: lateral unnest of the JSON history, text key join, ANSI timestamp cast."""
    return _hist(spark, sf)


@register("q_history_prefix", _with_history() + """
SELECT e.* FROM entries e JOIN fx_items i ON i.id = e.item_id WHERE starts_with(i.subject, '1')""")
def q_history_prefix(spark, sf):
    """O-04: the history read under a required key prefix, which keeps other dossiers out."""
    return _hist(spark, sf, replace(CFG, history_prefix="1"))


@register("q_history_latest", _with_history() + "\nSELECT item_id, state, state_date FROM latest")
def q_history_latest(spark, sf):
    """O-38, O-45: latest entry per (item, state), NULL date first; day formatting."""
    return history.latest_per_state(_hist(spark, sf))


@register("q_eav_insert_missing", _with_history("fx_fields", "fx_values") + f""", {_SOURCES},
{oracles.upsert("fx_values", "wanted", "given", "grown")}
SELECT '{CFG.entity_type}' AS customized_type, item_id AS customized_id, field_id AS custom_field_id, CAST(NULL AS VARCHAR) AS value
FROM grown_wanted ANTI JOIN grown_held USING (item_id, field_id)""")
def q_eav_insert_missing(spark, sf):
    """O-06, O-25 (composite anti join), O-15: bag of (item, field) rows to insert with NULL."""
    fx = fixtures(spark, sf, "fx_fields", "fx_values")
    ins, _ = history.history_datos(_hist(spark, sf))
    return eav.missing_rows(ins, fx["fx_fields"], fx["fx_values"], entity_type=CFG.entity_type,
                            field_ids=eav.fields_labelled(fx["fx_fields"], ins))


@register("q_eav_upsert", _with_history("fx_fields", "fx_values") + f""", {_SOURCES},
{oracles.upsert("fx_values", "wanted", "given", "grown")}
FROM grown""")
def q_eav_upsert(spark, sf):
    """O-10, O-54, O-11: history sync = insert missing with NULL (bag), then update from latest."""
    fx = fixtures(spark, sf, "fx_fields", "fx_values")
    ins, upd = history.history_datos(_hist(spark, sf))
    out = eav.upsert(fx["fx_values"], fx["fx_fields"], ins, upd, entity_type=CFG.entity_type,
                     field_ids=eav.fields_labelled(fx["fx_fields"], ins))
    return out.select("customized_type", "customized_id", "custom_field_id", "value")


@register("q_field_resolve", _with_history("fx_fields") + """
SELECT item_id, name AS attr, id AS field_id FROM fx_fields JOIN entries ON state = name""")
def q_field_resolve(spark, sf):
    """O-15: dictionary resolve by label (inner join on name)."""
    fx = fixtures(spark, sf, "fx_fields")
    e = _hist(spark, sf).select("item_id", F.col("state").alias("attr"))
    return eav.resolve_labels(e, fx["fx_fields"]).select("item_id", "attr", "field_id")


def configured_labels(cfg: SyncConfig) -> list[str]:
    out = [lab for _, lab in cfg.capacity_labels]
    out += [lab for lab, _ in cfg.registry_scalars]
    out += [cfg.registry_tristate[0], cfg.registry_doc_count_label, *cfg.registry_area_labels]
    out += [lab for _, lab in cfg.registry_class_labels]
    out += [lab for _, lab in cfg.bucket_labels]
    return sorted(set(out))


@register("q_unmatched_labels", _with_history("fx_fields") + f"""
SELECT attr FROM (SELECT state AS attr FROM entries UNION SELECT unnest({configured_labels(CFG) + ["no such label"]})) EXCEPT SELECT name FROM fx_fields""")
def q_unmatched_labels(spark, sf):
    """O-15 report: labels the run emits (history states, configured attribute labels and one
    that no dictionary has) that the dictionary does not carry: the rows the resolve drops."""
    fx = fixtures(spark, sf, "fx_fields")
    states = _hist(spark, sf).select(F.col("state").alias("attr"))
    labels = spark.createDataFrame([(lab,) for lab in configured_labels(CFG) + ["no such label"]], "attr string")
    return eav.unmatched_labels(states.unionByName(labels), fx["fx_fields"])
