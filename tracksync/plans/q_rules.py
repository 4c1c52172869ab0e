"""Catalog part 3: value rules, routing, due dates, links, ensured fields, classification.

Every update query returns its whole table, with ``hit`` on the rows the rule applies to.
"""

from __future__ import annotations

from ..operators import eav, links, routing, rules
from ..sources.fixtures import FIXTURE_CONFIG as CFG
from ..sources.fixtures import fixtures, oracle_ctes
from . import oracles
from .catalog import register

_VALUES = "\nSELECT id, customized_type, customized_id, custom_field_id, value, hit FROM out"
_ITEMS = "\nSELECT id, type_id, subject, project_id, hit FROM out"
_ROUTING = ("fx_items", "fx_values", "fx_fields", "fx_projects")


@register("q_decimal_comma", oracle_ctes("fx_fields", "fx_values") + ", " + oracles.decimal_comma("fx_values", "out") + _VALUES)
def q_decimal_comma(spark, sf):
    """O-57, O-27, O-47: decimal comma -> dot on float fields (rows of any entity type)."""
    fx = fixtures(spark, sf, "fx_fields", "fx_values")
    return rules.decimal_commas(fx["fx_values"], fx["fx_fields"], CFG, flag_col="hit")


@register("q_recode_yes_no", oracle_ctes("fx_values") + ", " + oracles.recode("fx_values", "out") + _VALUES)
def q_recode_yes_no(spark, sf):
    """O-58, O-48: exact recode of one field."""
    fx = fixtures(spark, sf, "fx_values")
    return rules.recode_flags(fx["fx_values"], CFG, flag_col="hit")


@register("q_route_by_value", oracle_ctes(*_ROUTING) + ", " + oracles.route("fx_items", "fx_values", CFG.dossier_type, "", "out") + _ITEMS)
def q_route_by_value(spark, sf):
    """O-60: dossier -> project named by its partner value (4-way join update)."""
    fx = fixtures(spark, sf, *_ROUTING)
    return routing.route_by_value(fx["fx_items"], fx["fx_values"], fx["fx_fields"], fx["fx_projects"], CFG, flag_col="hit")


@register("q_route_by_value_suffix", oracle_ctes(*_ROUTING) + ", " + oracles.route("fx_items", "fx_values", CFG.request_type, CFG.request_suffix, "out") + _ITEMS)
def q_route_by_value_suffix(spark, sf):
    """O-61, O-32, O-51: request -> project named by partner value || suffix (computed-key join)."""
    fx = fixtures(spark, sf, *_ROUTING)
    return routing.route_by_value(fx["fx_items"], fx["fx_values"], fx["fx_fields"], fx["fx_projects"], CFG,
                                  item_type=CFG.request_type, suffix=CFG.request_suffix, flag_col="hit")


_DUE = ("fx_values", "fx_fields", "fx_state_days")


@register("q_deadline_from_state", oracle_ctes(*_DUE) + ", " + oracles.due("fx_values", "due") + "\nFROM due")
def q_deadline_from_state(spark, sf):
    """O-62, O-31, O-46, O-45: due date = date of the field named by the state + state days."""
    fx = fixtures(spark, sf, *_DUE)
    return rules.due_dates(fx["fx_values"], fx["fx_fields"], fx["fx_state_days"], CFG)


@register("q_deadline_update", oracle_ctes(*_DUE) + ", " + oracles.due("fx_values", "due") + ", " + oracles.due_update("fx_values", "due", "out") + _VALUES)
def q_deadline_update(spark, sf):
    """O-62, O-09, O-28: the due dates written into the rows of the labelled due-date field."""
    fx = fixtures(spark, sf, *_DUE)
    return rules.apply_due_dates(fx["fx_values"], fx["fx_fields"], fx["fx_state_days"], CFG, flag_col="hit")


@register("q_link_items", oracle_ctes("fx_items", "fx_values", "fx_relations") + ", " + oracles.links("fx_items", "fx_values", "fx_relations", "out") + "\nFROM out")
def q_link_items(spark, sf):
    """O-63, O-26: request -> dossier links by reference value, minus existing edges either way."""
    fx = fixtures(spark, sf, "fx_items", "fx_values", "fx_relations")
    return links.link_items(fx["fx_items"], fx["fx_values"], fx["fx_relations"], CFG)


@register("q_ensure_field_left_null", oracle_ctes("fx_items", "fx_values") + ", " + oracles.lacking("fx_items", "fx_values", CFG.partner_field_id, "out") + "\nFROM out")
def q_ensure_field_left_null(spark, sf):
    """O-07, O-64: append the partner field for dossiers lacking it."""
    fx = fixtures(spark, sf, "fx_items", "fx_values")
    return links.ensure_field(fx["fx_items"], fx["fx_values"], CFG.partner_field_id, CFG)


@register("q_ensure_field_not_exists", oracle_ctes("fx_items", "fx_values") + ", " + oracles.lacking("fx_items", "fx_values", CFG.class_field_id, "out") + "\nFROM out")
def q_ensure_field_not_exists(spark, sf):
    """O-08, O-64: append the classification field for dossiers lacking it."""
    fx = fixtures(spark, sf, "fx_items", "fx_values")
    return links.ensure_field(fx["fx_items"], fx["fx_values"], CFG.class_field_id, CFG)


def _fill(spark, sf, item_type):
    fx = fixtures(spark, sf, "fx_items", "fx_values", "fx_projects")
    return routing.fill_from_project(fx["fx_values"], fx["fx_items"], fx["fx_projects"], CFG, item_type=item_type, flag_col="hit")


@register("q_fill_from_project", oracle_ctes("fx_items", "fx_values", "fx_projects") + ", " + oracles.fill("fx_values", "fx_items", CFG.dossier_type, "out") + _VALUES)
def q_fill_from_project(spark, sf):
    """O-65, O-49: empty partner value of a dossier <- its project's name without the suffix word."""
    return _fill(spark, sf, CFG.dossier_type)


@register("q_fill_from_project_requests", oracle_ctes("fx_items", "fx_values", "fx_projects") + ", " + oracles.fill("fx_values", "fx_items", CFG.request_type, "out") + _VALUES)
def q_fill_from_project_requests(spark, sf):
    """O-65, O-49: the same on requests, whose projects carry the suffix in two spellings."""
    return _fill(spark, sf, CFG.request_type)


@register("q_classify_presence", oracle_ctes("fx_items", "fx_values") + ", " + oracles.classify("fx_values", "fx_items", "fx_values", "out") + _VALUES)
def q_classify_presence(spark, sf):
    """O-66, O-24, O-19: four codes from the presence of two probe fields."""
    fx = fixtures(spark, sf, "fx_items", "fx_values")
    return rules.classify_presence(fx["fx_items"], fx["fx_values"], CFG, flag_col="hit")


@register("q_reroute_to_parent", oracle_ctes("fx_items", "fx_values", "fx_relations", "fx_projects") + ", "
          + oracles.reroute("fx_items", "fx_values", "fx_relations", "out") + _ITEMS)
def q_reroute_to_parent(spark, sf):
    """O-67: linked dossier -> parent project of the request's project."""
    fx = fixtures(spark, sf, "fx_items", "fx_values", "fx_relations", "fx_projects")
    return routing.reroute_to_parent(fx["fx_items"], fx["fx_values"], fx["fx_relations"], fx["fx_projects"], CFG, flag_col="hit")


_NAMED = """named AS MATERIALIZED (
  SELECT customized_id, name, min(value) AS value FROM (SELECT id AS custom_field_id, name FROM fx_fields) JOIN fx_values USING (custom_field_id)
  WHERE customized_type = '%s' GROUP BY ALL)""" % CFG.entity_type
WIDE_FIELDS = ["PARTNER", "click", "current_state", "due_date", "error", "has_pole", "hidden_flag", "installed_m", "pending",
               "proposed", "purchase", "ref_id", "replan_kind", "route. no", "signup", "used_m", "view"]
_PIVOT = "PIVOT named ON name IN (" + ", ".join(f"'{n}'" for n in WIDE_FIELDS) + ") USING min(value) GROUP BY customized_id"


@register("q_eav_pivot", oracle_ctes("fx_values", "fx_fields") + ", " + _NAMED + f"\nFROM ({_PIVOT})")
def q_eav_pivot(spark, sf):
    """O-43 (wide form): EAV -> one column per named field (a label with a dot among them)."""
    fx = fixtures(spark, sf, "fx_values", "fx_fields")
    return eav.pivot_wide(fx["fx_values"], fx["fx_fields"], WIDE_FIELDS, entity_type=CFG.entity_type)


@register("q_eav_json_object", oracle_ctes("fx_values", "fx_fields") + ", " + _NAMED + """
SELECT customized_id, '{' || string_agg(CAST(to_json(name) AS VARCHAR) || ':' || coalesce(CAST(to_json(value) AS VARCHAR), 'null'), ',' ORDER BY name) || '}' AS custom_fields
FROM named GROUP BY customized_id""")
def q_eav_json_object(spark, sf):
    """O-43 (export-view form): EAV -> one JSON object of custom fields per item."""
    fx = fixtures(spark, sf, "fx_values", "fx_fields")
    return eav.json_object_per_item(fx["fx_values"], fx["fx_fields"], entity_type=CFG.entity_type)
