"""O-68: the full synchronisation run, twenty steps in order, each seeing the previous writes.

The run is a chain of DataFrame rewrites of three tables (items, values,
relations).  Lineage is cut by tables written below the shared ``spark.checkpoint.dir``
after the steps that grow or rewrite a table (for the EAV table: only the buckets of the
fields a step touches, :mod:`tracksync.plans.eav_store`), so the plans stay small
and a lost executor recomputes from the last table, not from the sources.  (A written table and
not ``checkpoint()``: a checkpointed frame keeps the constraints the optimizer inferred, and
these grow with every update.)  Inputs computed once and written feed both halves of an upsert (insert,
then update), so both see one snapshot.  Nothing is published here; see
:mod:`tracksync.plans.publish`.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..operators import eav, history, items as items_ops, links, registry, routing, rules, spatial
from ..operators.ids import IdSequence
from ..session import ensure_checkpoint_dir, scratch_path
from .eav_store import EavTable


@dataclass
class SyncInputs:
    items: DataFrame
    values: DataFrame | EavTable
    fields: DataFrame
    projects: DataFrame
    relations: DataFrame
    state_days: DataFrame
    history: DataFrame
    registry: DataFrame
    element: DataFrame
    conduct: DataFrame
    md: DataFrame
    points: DataFrame
    area_layers: Sequence[tuple[str, DataFrame]]  # (label, edges)


def _cut(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"sync-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Clock:
    def __init__(self, log):
        self.log, self.t = log, time.perf_counter()

    def __call__(self, step: str) -> None:
        if self.log is not None:
            now = time.perf_counter()
            self.log(step, now - self.t)
            self.t = now


def rewritten_fields(inp: SyncInputs, cfg: SyncConfig, *others: int) -> DataFrame:
    """(custom_field_id) of the fields whose values steps 8 and 9 rewrite in place, and of ``others``."""
    floats = inp.fields.filter(F.col("field_format") == F.lit(cfg.float_format)).select(F.col("id").alias("custom_field_id"))
    kind = inp.fields.schema["id"].dataType
    fixed = inp.fields.sparkSession.createDataFrame([(i,) for i in (cfg.recode_field_id, *others)], "i long").select(F.col("i").cast(kind).alias("custom_field_id"))
    return floats.unionByName(fixed).distinct()


def fields_used(inp: SyncInputs, entries: DataFrame, cfg: SyncConfig) -> DataFrame:
    """(custom_field_id) of every field a step reads or writes: by label, by format, by configured id."""
    labels = [lab for _, lab in cfg.capacity_labels] + registry.registry_labels(cfg) + [lab for _, lab in cfg.bucket_labels]
    by_label = eav.fields_labelled(inp.fields, labels + [cfg.partner_label, cfg.due_label])
    states = entries.select(F.col("state").alias("attr")).unionByName(inp.state_days.select(F.col("state").alias("attr")))
    rest = rewritten_fields(inp, cfg, cfg.partner_field_id, cfg.ref_field_id, cfg.state_field_id, cfg.class_field_id,
                            cfg.probe_a_field_id, cfg.probe_b_field_id)
    return by_label.unionByName(eav.fields_labelled(inp.fields, states)).unionByName(rest).distinct()


def run_sync(inp: SyncInputs, cfg: SyncConfig, run_ts: _dt.datetime | None = None,
             store: str | None = None, log=None) -> Mapping[str, DataFrame | EavTable]:
    """Run Q1..Q20; returns the new ``items``, ``values`` and ``relations`` tables.

    ``inp.values`` as an :class:`EavTable` (that of the last run): steps write new versions of the
    buckets they touch beside the old ones, and ``values`` of the result is the new table.  As a
    DataFrame with ``store``, a folder: all rows are written there first, once.  As a DataFrame
    alone: it is scanned once, the rows of all fields that any step reads or writes are split
    off into a table of the shared scratch folder, and the rest joins the result untouched.
    ``log(step, seconds)`` is called after each step when given.
    """
    spark = inp.items.sparkSession
    ensure_checkpoint_dir(spark)
    clock = _Clock(log)
    et = cfg.entity_type
    fields, projects = inp.fields, inp.projects
    given = inp.values.read() if isinstance(inp.values, EavTable) else inp.values
    item_ids, value_ids = IdSequence.from_table(inp.items), IdSequence.from_table(given)
    def upsert_step(table: EavTable, ins: DataFrame, upd: DataFrame, labels) -> EavTable:
        ids = _cut(eav.fields_labelled(fields, labels), "fields")
        return table.replaced(ids, lambda t: eav.upsert(t, fields, ins, upd, entity_type=et, seq=value_ids, field_ids=ids))

    # Q1 seed items (the new rows are checkpointed by the id assignment)
    items = items_ops.append_items(inp.items, items_ops.seed_rows(inp.registry, inp.items, cfg, run_ts), item_ids)
    relations = inp.relations
    # (id, subject) never change after seeding; hash-partitioned on subject once, it serves the
    # four subject joins below (history, capacity, registry, buckets) without re-shuffling items
    keyed = items.select("id", "subject").repartition("subject").persist()
    clock("q01_seed")

    # Q2 + Q3 history: insert every (item, state) lacking a row, then the latest date per state
    entries = _cut(history.history_entries(keyed, inp.history, cfg), "entries")
    ins, upd = history.history_datos(entries)
    used, untouched = _cut(fields_used(inp, entries, cfg), "fields"), None
    if isinstance(inp.values, EavTable):
        table = inp.values
    elif store is not None:
        table = EavTable.create(inp.values, store)
    else:
        touched, untouched = eav.split_by_fields(inp.values, used)
        table = EavTable.create(touched, scratch_path(spark, "sync-values"))
    table = upsert_step(table, ins, upd, ins)
    clock("q02_q03_history")

    # Q4 + Q5 capacity attributes (one computation feeds insert and update)
    cap = _cut(registry.attach_items(registry.capacity_long(inp.registry, inp.element, inp.conduct, cfg), keyed), "capacity")
    table = upsert_step(table, cap, cap, [lab for _, lab in cfg.capacity_labels])
    clock("q04_q05_capacity")

    # Q6 + Q7 registry attributes (five families)
    layers = [(label, spatial.points_in_areas(inp.points, edges))
              for label, edges in inp.area_layers]
    reg = _cut(registry.attach_items(registry.registry_attributes(inp.registry, inp.element, inp.md, layers, cfg),
                                     keyed), "registry")
    table = upsert_step(table, reg, reg, registry.registry_labels(cfg))
    clock("q06_q07_registry")

    # Q8 decimal commas, Q9 recode: narrow projections over the fields they can change
    table = table.replaced(rewritten_fields(inp, cfg), lambda t: rules.recode_flags(rules.decimal_commas(t, fields, cfg), cfg))
    clock("q08_q09_rewrites")

    # Q10 + Q11 bucket attributes
    bk = _cut(registry.attach_items(registry.bucket_attributes(inp.registry, inp.element, cfg), keyed), "buckets")
    keyed.unpersist()
    table = upsert_step(table, bk, bk, [lab for _, lab in cfg.bucket_labels])
    clock("q10_q11_buckets")

    # Q12 + Q13 routing by partner value
    values = table.read(used)
    items = routing.route_by_value(items, values, fields, projects, cfg)
    items = routing.route_by_value(items, values, fields, projects, cfg, item_type=cfg.request_type,
                                   suffix=cfg.request_suffix)
    items = _cut(items, "items")
    clock("q12_q13_routing")

    # Q14 due dates (computed from the whole table, written into the due-date field rows)
    target = rules.due_dates(values, fields, inp.state_days, cfg).select(
        "customized_id", F.col("due_date").alias("new_value"))
    table = table.replaced(eav.fields_labelled(fields, [cfg.due_label]), lambda t: eav.apply_update(t, target, keys=["customized_id"]))
    values = table.read(used)
    clock("q14_due_dates")

    # Q15 links
    relations = _cut(links.link_items(items, values, relations, cfg), "links").unionByName(relations)
    clock("q15_links")

    # Q16 ensure partner field, Q17 fill it from the project name
    pf = cfg.partner_field_id
    table = table.replaced([pf], lambda t: routing.fill_from_project(
        eav.append_with_ids(t, links.ensure_field(items, t, pf, cfg), value_ids), items, projects, cfg))
    clock("q16_q17_partner")

    # Q18 ensure classification field, Q19 classify by presence of the two probe fields
    cf = cfg.class_field_id
    codes = rules.presence_source(items, table.read(used), cfg)
    table = table.replaced([cf], lambda t: eav.apply_update(
        eav.append_with_ids(t, links.ensure_field(items, t, cf, cfg), value_ids), codes, entity_type=et))
    clock("q18_q19_classify")

    # Q20 re-route linked dossiers to the parent project
    items = _cut(routing.reroute_to_parent(items, table.read(used), relations, projects, cfg), "items")
    clock("q20_reroute")
    values = table if untouched is None else table.read().unionByName(untouched)
    return {"items": items, "values": values, "relations": relations}
