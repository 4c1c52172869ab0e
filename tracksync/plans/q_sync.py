"""Catalog part 5: the full synchronisation run (O-68) against the statements of its steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.fixtures import FIXTURE_CONFIG as CFG
from ..sources.fixtures import fixtures, oracle_ctes
from . import oracles as o
from .catalog import register
from .q_export import RUN_TS
from .sync import SyncInputs, run_sync

_ALL = ("fx_projects", "fx_items", "fx_fields", "fx_values", "fx_relations", "fx_state_days", "fx_history",
        "fx_registry", "fx_element", "fx_conduct", "fx_md", "fx_points", "fx_area_edges", "fx_zone_edges")
_EAV = "customized_type, customized_id, custom_field_id, value"


def _plain(cte: str, out: str, columns: str) -> str:
    return f"{out} AS MATERIALIZED (SELECT {columns} FROM {cte})"


def full_sync_oracle() -> str:
    """The twenty steps in order; every step names the tables it reads and the one it leaves."""
    items = "id, type_id, subject, project_id"
    steps = [
        oracle_ctes(*_ALL).rstrip(),
        # new dossiers for numbers no item has, numbered on in subject order
        f"""fresh AS MATERIALIZED (
  SELECT num AS subject FROM fx_registry WHERE NOT starts_with(num, '{CFG.seed_exclude_prefix}') AND num NOT IN (SELECT subject FROM fx_items)),
items1 AS MATERIALIZED (
  SELECT {items} FROM fx_items UNION ALL
  SELECT (SELECT max(id) FROM fx_items) + row_number() OVER (ORDER BY subject), {CFG.seed.type_id}, subject, {CFG.seed.project_id} FROM fresh)""",
        _plain("fx_values", "v0", _EAV),
        o.history("items1"),
        "wanted AS (SELECT item_id, state AS attr FROM entries), given AS (SELECT item_id, state AS attr, state_date AS value FROM latest)",
        o.upsert("v0", "wanted", "given", "v1"),
        o.REGISTRY, o.CAPACITY, o.attached("capacity_long", "items1", "told2"), o.upsert("v1", "told2", "told2", "v2"),
        o.attached("registry_long", "items1", "told3"), o.upsert("v2", "told3", "told3", "v3"),
        o.decimal_comma("v3", "w4"), _plain("w4", "v4", _EAV),
        o.recode("v4", "w5"), _plain("w5", "v5", _EAV),
        o.BUCKETS, o.buckets_long(*[lab for _, lab in CFG.bucket_labels]), o.attached("buckets_long", "items1", "told6"), o.upsert("v5", "told6", "told6", "v6"),
        o.route("items1", "v6", CFG.dossier_type, "", "i2"), _plain("i2", "items2", items),
        o.route("items2", "v6", CFG.request_type, CFG.request_suffix, "i3"), _plain("i3", "items3", items),
        o.due("v6", "due"), o.due_update("v6", "due", "w7"), _plain("w7", "v7", _EAV),
        o.links("items3", "v7", "fx_relations", "added"), "relations1 AS (SELECT from_id, to_id, relation_type FROM fx_relations UNION ALL FROM added)",
        o.lacking("items3", "v7", CFG.partner_field_id, "new8"), "v8 AS MATERIALIZED (FROM v7 UNION ALL FROM new8)",
        o.fill("v8", "items3", CFG.dossier_type, "w9"), _plain("w9", "v9", _EAV),
        o.lacking("items3", "v9", CFG.class_field_id, "new10"), "v10 AS MATERIALIZED (FROM v9 UNION ALL FROM new10)",
        o.classify("v10", "items3", "v10", "w11"), _plain("w11", "v11", _EAV),
        o.reroute("items3", "v11", "relations1", "i4"), _plain("i4", "items4", items),
    ]
    return ",\n".join(steps) + "\n"


def inputs(spark, sf) -> SyncInputs:
    fx = fixtures(spark, sf, *_ALL)
    return SyncInputs(items=fx["fx_items"], values=fx["fx_values"], fields=fx["fx_fields"],
                      projects=fx["fx_projects"], relations=fx["fx_relations"], state_days=fx["fx_state_days"],
                      history=fx["fx_history"], registry=fx["fx_registry"], element=fx["fx_element"],
                      conduct=fx["fx_conduct"], md=fx["fx_md"], points=fx["fx_points"],
                      area_layers=list(zip(CFG.registry_area_labels, (fx["fx_area_edges"], fx["fx_zone_edges"]), strict=True)))


_ORACLE = full_sync_oracle()


@register("q_full_sync_items", _ORACLE + "FROM items4")
def q_full_sync_items(spark, sf):
    """O-68: items after the twenty steps (seeded items get dense ids in subject order)."""
    return run_sync(inputs(spark, sf), CFG, RUN_TS)["items"].select("id", "type_id", "subject", "project_id")


@register("q_full_sync_values", _ORACLE + "FROM v11")
def q_full_sync_values(spark, sf):
    """O-68, O-10: the EAV table after the twenty steps (row ids are surrogates, not compared)."""
    return run_sync(inputs(spark, sf), CFG, RUN_TS)["values"].select("customized_type", "customized_id", "custom_field_id", "value")


@register("q_full_sync_relations", _ORACLE + "FROM relations1")
def q_full_sync_relations(spark, sf):
    """O-68: relations after the link step."""
    return run_sync(inputs(spark, sf), CFG, RUN_TS)["relations"].select("from_id", "to_id", F.col("relation_type"))
