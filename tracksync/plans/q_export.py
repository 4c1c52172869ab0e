"""Catalog part 4: seeding, API items (filter, projection, saved pages) and exports."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import functions as F

from ..functions import clean_string_columns, clean_text, raw_or_self
from ..operators import export, items
from ..session import scratch_path
from ..sources.fixtures import FIXTURE_CONFIG as CFG
from ..sources.fixtures import FX_SQL, api_items, fixtures, oracle_ctes, page_lines, read_table
from ..sources.item_table import read_items, save_items
from ..sources.pages import items_of_pages
from .catalog import register
from .publish import publish, read_current
from .q_rules import _NAMED

RUN_TS = _dt.datetime(2024, 6, 1, 5, 30, 0)
LABELS = {1: "order_status", 2: "order_priority", 3: "customer", 4: "order_key", 5: "flag. text"}
FILTERS = {"customField1": ["F", "O"], "customField2": ["1-URGENT"]}
PAGE_SIZE = 1000

_SUBJECT = "CASE WHEN o_orderkey % 17 = 0 THEN '{' ELSE '' END || 'ORD-' || o_orderkey"
_PROJ = f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, {_SUBJECT} AS subject,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Request' ELSE 'Dossier' END AS type,
  o_orderstatus AS order_status, o_orderpriority AS order_priority,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer,
  CAST(o_orderkey AS VARCHAR) AS order_key, 'true' AS "flag. text"
FROM orders"""
_WHERE_FILTERS = "\nWHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT')"


def _items_map(spark, sf):
    return api_items(read_table(spark, sf, "orders")).select(export.parse_items(F.col("item_json")).alias("item"))


def _paged_items(spark, sf):
    return items_of_pages(page_lines(api_items(read_table(spark, sf, "orders")), PAGE_SIZE), PAGE_SIZE)


@register("q_seed_missing_items", oracle_ctes("fx_registry", "fx_items") + f"""
SELECT {CFG.seed.type_id} AS type_id, {CFG.seed.project_id} AS project_id, num AS subject, '' AS description, {CFG.seed.status_id} AS status_id,
       {CFG.seed.priority_id} AS priority_id, {CFG.seed.author_id} AS author_id, {CFG.seed.lock_version} AS lock_version,
       TIMESTAMP '{RUN_TS}' AS created_at, TIMESTAMP '{RUN_TS}' AS updated_at, FALSE AS schedule_manually, FALSE AS ignore_non_working_days
FROM fx_registry ANTI JOIN (SELECT subject AS num FROM fx_items) USING (num) WHERE NOT starts_with(num, '{CFG.seed_exclude_prefix}')""")
def q_seed_missing_items(spark, sf):
    """O-53, O-05, O-04, O-52: registry numbers missing as item subjects -> new items (bag)."""
    fx = fixtures(spark, sf, "fx_registry", "fx_items")
    return items.seed_rows(fx["fx_registry"], fx["fx_items"], CFG, RUN_TS)


@register("q_filter_and", _PROJ + _WHERE_FILTERS)
def q_filter_and(spark, sf):
    """O-14, O-16, O-17: AND-of-INs filter over API items, then the label projection."""
    return export.export_filtered(_items_map(spark, sf), FILTERS, LABELS)


@register("q_filter_types", _PROJ + "\nWHERE o_orderkey % 2 = 0")
def q_filter_types(spark, sf):
    """O-14: the text "true" is not the boolean: the filter value "true" finds texts alone."""
    return export.export_filtered(_items_map(spark, sf), {"customField5": ["true"]}, LABELS)


@register("q_label_projection", _PROJ)
def q_label_projection(spark, sf):
    """O-16, O-17: every API item projected to fixed columns plus labelled custom fields."""
    return export.label_projection(_items_map(spark, sf), LABELS)


@register("q_subject_coalesce", f"SELECT o_orderkey AS id, {_SUBJECT} AS subject FROM orders")
def q_subject_coalesce(spark, sf):
    """O-17: subject given as text or as {"raw": text} -> text."""
    return api_items(read_table(spark, sf, "orders")).select(
        "id", raw_or_self(F.variant_get(F.parse_json("item_json"), "$.subject", "variant")).alias("subject"))


@register("q_page_envelope", _PROJ)
def q_page_envelope(spark, sf):
    """O-03: saved 1000-item pages, the last one short or none, then a broken one without a number
    and one that must not be read."""
    return export.label_projection(_paged_items(spark, sf), LABELS)


@register("q_export_filtered", _PROJ + _WHERE_FILTERS)
def q_export_filtered(spark, sf):
    """O-69: saved pages -> AND-of-INs filter -> label projection (the filtered export)."""
    return export.export_filtered(_paged_items(spark, sf), FILTERS, LABELS)


@register("q_export_saved_items", _PROJ + _WHERE_FILTERS)
def q_export_saved_items(spark, sf):
    """O-69, O-14, O-16: pages saved as shredded items, then filter and projection over the members they name."""
    saved = save_items(_paged_items(spark, sf).select("item"), scratch_path(spark, "items"))
    return export.export_filtered(read_items(spark, saved), FILTERS, LABELS)


@register("q_clean_text", r"""
SELECT doc_id, regexp_replace(text, '[^\x20-\x7E]', '', 'g') AS text FROM documents""")
def q_clean_text(spark, sf):
    """O-50: drop characters outside printable ASCII, over whole document texts."""
    return read_table(spark, sf, "documents").select("doc_id", clean_text("text").alias("text"))


@register("q_json_widen", r"""
SELECT CAST(event_id AS VARCHAR) AS subject,
       regexp_replace(json_extract_string(props, '$.k'), '[^\x20-\x7E]', '', 'g') AS k FROM events""")
def q_json_widen(spark, sf):
    """O-42, O-50: JSON object column -> one column per key, text-cleaned."""
    view = read_table(spark, sf, "events").select(F.col("event_id").cast("string").alias("subject"), F.col("props").alias("custom_fields"))
    return clean_string_columns(export.widen_json(view, "custom_fields", ["subject"], ["k"]))


_EXPORT = ("fx_items", "fx_values", "fx_fields")
_FIELD_NAMES = sorted(re.findall(r"\(\d+,'([^']+)'", FX_SQL["fx_fields"]))
_CLEAN = r"regexp_replace({0}, '[^\x20-\x7E]', '', 'g')"


_EXPORT_ORACLE = oracle_ctes(*_EXPORT) + ", " + _NAMED + """,
wide AS (PIVOT named ON name IN (""" + ", ".join(f"'{n}'" for n in _FIELD_NAMES) + """) USING any_value(value) GROUP BY customized_id)
SELECT """ + ", ".join(_CLEAN.format(c) + " AS " + c for c in ["subject", *(f'"{n}"' for n in _FIELD_NAMES)]) + """
FROM fx_items LEFT JOIN wide ON wide.customized_id = fx_items.id"""


@register("q_export_all", _EXPORT_ORACLE)
def q_export_all(spark, sf):
    """O-70, O-43, O-42, O-50: every item, its custom fields as one JSON object, widened over the keys
    that occur and the dictionary's (a dotted label among them), text-cleaned."""
    fx = fixtures(spark, sf, *_EXPORT)
    return export.export_all(fx["fx_items"], fx["fx_values"], fx["fx_fields"], CFG.entity_type)


@register("q_export_pivot", _EXPORT_ORACLE)
def q_export_pivot(spark, sf):
    """O-43, O-50: the same rows from the EAV table by one pivot over the dictionary."""
    fx = fixtures(spark, sf, *_EXPORT)
    return export.export_pivot(fx["fx_items"], fx["fx_values"], fx["fx_fields"], CFG.entity_type)


# a row of event k has the keys of its remainders: k, and one to four more; the columns come from the data
_PROPS = """SELECT event_id, props, event_type, user_id,
  CASE WHEN event_id % 2 = 0 THEN 'type_' || event_type END AS by_type, CASE WHEN event_id % 3 = 0 THEN 'user. ' || (user_id % 20) END AS by_user FROM events"""
_PROPS_PAIRS = f"""WITH given AS ({_PROPS})
  SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM given
  UNION ALL SELECT event_id, by_type, 'é' || user_id FROM given WHERE by_type IS NOT NULL
  UNION ALL SELECT event_id, by_user, event_type FROM given WHERE by_user IS NOT NULL"""


@register("q_json_union", rf"""
FROM (PIVOT (SELECT CAST(event_id AS VARCHAR) AS subject, key, regexp_replace(value, '[^\x20-\x7E]', '', 'g') AS value FROM ({_PROPS_PAIRS}))
ON key USING any_value(value) GROUP BY subject)""")
def q_json_union(spark, sf):
    """O-42, O-50: JSON objects of differing key sets -> one column for every key that occurs."""
    given = read_table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("subject"), F.get_json_object("props", "$.k").alias("k"), "user_id", "event_type",
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("type_"), "event_type")).alias("by_type"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("user. "), (F.col("user_id") % 20).cast("string"))).alias("by_user"))
    pairs = F.filter(F.array(F.struct(F.lit("k").alias("key"), F.col("k").alias("value")),
                             F.struct(F.col("by_type").alias("key"), F.concat(F.lit("é"), F.col("user_id").cast("string")).alias("value")),
                             F.struct(F.col("by_user").alias("key"), F.col("event_type").alias("value"))), lambda p: p["key"].isNotNull())
    view = given.select("subject", F.to_json(F.map_from_entries(pairs)).alias("custom_fields"))
    return clean_string_columns(export.widen_json(view, "custom_fields", ["subject"]))


@register("q_publish_export", _EXPORT_ORACLE)
def q_publish_export(spark, sf):
    """O-12, O-13: the full export published as a run; a reader finds it through the pointer."""
    root = scratch_path(spark, "published")
    publish(spark, {"export": q_export_all(spark, sf)}, root)
    return read_current(spark, root, "export")
