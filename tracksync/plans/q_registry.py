"""Catalog part 2: registry aggregates, unpivots, spatial tags and their upserts."""

from __future__ import annotations

from dataclasses import replace

from ..operators import eav, registry, spatial
from ..sources.fixtures import FIXTURE_CONFIG as CFG
from ..sources.fixtures import fixtures, oracle_ctes
from . import oracles
from .catalog import register

_ELEMENTS = ("fx_registry", "fx_element")
_FAN = (*_ELEMENTS, "fx_conduct")
_ALL = (*_ELEMENTS, "fx_md", "fx_points", "fx_area_edges", "fx_zone_edges")
_TABLES = ("fx_items", "fx_fields", "fx_values")


def _sql(views: tuple[str, ...], *ctes: str, select: str) -> str:
    return oracle_ctes(*views) + ", " + ", ".join((oracles.ACTIVE, *ctes)) + "\n" + select


def _upsert_sql(views: tuple[str, ...], *ctes: str, long_rows: str) -> str:
    return _sql((*views, *_TABLES), *ctes, oracles.attached(long_rows, "fx_items", "told"), oracles.upsert("fx_values", "told", "told", "grown"), select="FROM grown")


def layers(fx) -> list:
    edges = (fx["fx_area_edges"], fx["fx_zone_edges"])
    return [(label, spatial.points_in_areas(fx["fx_points"], e)) for label, e in zip(CFG.registry_area_labels, edges, strict=True)]


def _registry_rows(spark, sf):
    fx = fixtures(spark, sf, *_ALL)
    return registry.registry_attributes(fx["fx_registry"], fx["fx_element"], fx["fx_md"], layers(fx), CFG)


def _upsert(spark, sf, long_rows, labels):
    fx = fixtures(spark, sf, *_TABLES)
    datos = registry.attach_items(long_rows, fx["fx_items"])
    out = eav.upsert(fx["fx_values"], fx["fx_fields"], datos, datos, entity_type=CFG.entity_type,
                     field_ids=eav.fields_labelled(fx["fx_fields"], labels))
    return out.select("customized_type", "customized_id", "custom_field_id", "value")


@register("q_capacity_long", _sql(_FAN, oracles.CAPACITY, select="SELECT num, attr, value FROM capacity_long"))
def q_capacity_long(spark, sf):
    """O-23, O-33, O-36, O-41 (R5): fan-out counts pre-aggregated per owner, unpivoted."""
    fx = fixtures(spark, sf, *_FAN)
    return registry.capacity_long(fx["fx_registry"], fx["fx_element"], fx["fx_conduct"], CFG)


@register("q_has_class_flag", _sql(_FAN, oracles.CAPACITY, select="SELECT num, installed, used, has_pole FROM capacity"))
def q_has_class_flag(spark, sf):
    """O-36, O-19: any POLE element in the fan-out -> yes / no code."""
    fx = fixtures(spark, sf, *_FAN)
    return registry.capacity(fx["fx_registry"], fx["fx_element"], fx["fx_conduct"], CFG).select("num", "installed", "used", "has_pole")


@register("q_count_left_join", _sql(("fx_registry", "fx_md"), oracles.DOCS, select="SELECT num, n_docs FROM docs"))
def q_count_left_join(spark, sf):
    """O-24, O-33: COUNT of matches over a left join, zeros kept."""
    fx = fixtures(spark, sf, "fx_registry", "fx_md")
    return registry.doc_counts(fx["fx_registry"], fx["fx_md"], CFG)


@register("q_bucket_counts", _sql(_ELEMENTS, oracles.MARKED, oracles.BUCKETS, select="FROM buckets"))
def q_bucket_counts(spark, sf):
    """O-34, O-18: seven overlapping conditional buckets plus total, one pass, 3VL kept."""
    fx = fixtures(spark, sf, *_ELEMENTS)
    return registry.bucket_counts(fx["fx_registry"], fx["fx_element"], CFG)


@register("q_class_counts_long", _sql(_ELEMENTS, oracles.MARKED, oracles.CLASSES, select="SELECT num, attr, value FROM classes_long"))
def q_class_counts_long(spark, sf):
    """O-35: four class counts by num, unpivoted."""
    fx = fixtures(spark, sf, *_ELEMENTS)
    return registry.class_counts_by_num(fx["fx_registry"], fx["fx_element"], CFG)


@register("q_unpivot_attributes", _sql(("fx_registry",), oracles.SCALARS, select="SELECT num, attr, value FROM scalars"))
def q_unpivot_attributes(spark, sf):
    """O-41, O-20, O-21: one scan of the registry unpivoted to (num, attr, value), NULLs kept;
    doubles as the source database writes them, a label with a dot."""
    fx = fixtures(spark, sf, "fx_registry")
    return registry.scalar_attributes(fx["fx_registry"], CFG)


@register("q_bool_label", _sql(("fx_registry",), select=f"SELECT id, num, {oracles.TRI_STATE} AS hidden_label FROM active"))
def q_bool_label(spark, sf):
    """O-19: searched CASE over a three-valued boolean."""
    reg = registry.active_registry(fixtures(spark, sf, "fx_registry")["fx_registry"], CFG)
    return reg.select("id", "num", registry.tri_state("hidden", CFG).alias("hidden_label"))


@register("q_json_agg", _sql(_ELEMENTS, select="""
SELECT num, miga, state, CAST(to_json(list(kind ORDER BY gid)) AS VARCHAR) AS kinds, CAST(to_json(list(uso ORDER BY gid)) AS VARCHAR) AS usos
FROM fx_element JOIN active ON active.id = owner_id GROUP BY ALL"""))
def q_json_agg(spark, sf):
    """O-37: JSON arrays per group that keep NULL elements, ordered by gid."""
    fx = fixtures(spark, sf, *_ELEMENTS)
    return registry.element_json_lists(fx["fx_registry"], fx["fx_element"], CFG)


@register("q_json_segments", _sql(_ELEMENTS, select="""
SELECT num, miga, state, CAST(gid // 10000 AS BIGINT) AS segment, CAST(to_json(list(kind ORDER BY gid)) AS VARCHAR) AS kinds,
 CAST(to_json(list(uso ORDER BY gid)) AS VARCHAR) AS usos
FROM fx_element JOIN active ON active.id = owner_id GROUP BY ALL"""))
def q_json_segments(spark, sf):
    """O-37 for groups of any size: the arrays of q_json_agg in ordered pieces of 10,000 gids."""
    fx = fixtures(spark, sf, *_ELEMENTS)
    return registry.element_json_segments(fx["fx_registry"], fx["fx_element"], CFG)


@register("q_spatial_point_in_area", oracle_ctes("fx_points", "fx_area_edges") + ", " + oracles.points_in("fx_area_edges", "in_area") + "\nFROM in_area")
def q_spatial_point_in_area(spark, sf):
    """O-30 (R10): grid equi-join + exact boundary-inclusive test over areas of which two share a
    name; the oracle is brute force."""
    fx = fixtures(spark, sf, "fx_points", "fx_area_edges")
    return spatial.points_in_areas(fx["fx_points"], fx["fx_area_edges"])


@register("q_spatial_tag_registry", _sql(_ALL, oracles.AREAS, select="FROM tags_area UNION ALL FROM tags_zone"))
def q_spatial_tag_registry(spark, sf):
    """O-30, O-22: registry x element x point-in-area -> (num, layer, name), bag, two layers."""
    fx = fixtures(spark, sf, *_ALL)
    parts = [registry.area_tags(fx["fx_registry"], fx["fx_element"], found, label, CFG) for label, found in layers(fx)]
    return parts[0].unionByName(parts[1])


@register("q_registry_attributes", oracle_ctes(*_ALL) + ", " + oracles.REGISTRY + "\nSELECT num, attr, value FROM registry_long")
def q_registry_attributes(spark, sf):
    """O-56 source, O-40: five attribute families, 22 attributes, in one UNION ALL."""
    return _registry_rows(spark, sf)


_BUCKETS = (oracles.MARKED, oracles.BUCKETS, oracles.buckets_long(*[lab for _, lab in CFG.bucket_labels]))


@register("q_bucket_attributes", _sql(_ELEMENTS, *_BUCKETS, select="SELECT num, attr, value FROM buckets_long"))
def q_bucket_attributes(spark, sf):
    """O-59 source: three of the seven buckets, unpivoted."""
    fx = fixtures(spark, sf, *_ELEMENTS)
    return registry.bucket_attributes(fx["fx_registry"], fx["fx_element"], CFG)


@register("q_eav_update_from", _sql((*_FAN, *_TABLES), oracles.CAPACITY, oracles.attached("capacity_long", "fx_items", "told"), """
source AS MATERIALIZED (SELECT item_id, f.id AS field_id, min(value) AS fresh, TRUE AS met FROM told JOIN fx_fields f ON f.name = attr GROUP BY ALL)""", select="""
SELECT id, customized_type, customized_id, custom_field_id, if(coalesce(met, FALSE), fresh, value) AS value,
       coalesce(met, FALSE) AND value IS DISTINCT FROM fresh AS changed
FROM fx_values LEFT JOIN source ON (item_id, field_id) = (customized_id, custom_field_id)"""))
def q_eav_update_from(spark, sf):
    """O-09: UPDATE ... FROM through the dictionary; duplicates reduced by min, hit flag,
    no entity-type guard (rows of another entity sharing the id are updated too)."""
    fx = fixtures(spark, sf, *_FAN, *_TABLES)
    long_rows = registry.capacity_long(fx["fx_registry"], fx["fx_element"], fx["fx_conduct"], CFG)
    src = eav.source_by_label(registry.attach_items(long_rows, fx["fx_items"]), fx["fx_fields"])
    return eav.apply_update(fx["fx_values"], src, changed_col="changed",
                            field_ids=eav.fields_labelled(fx["fx_fields"], [lab for _, lab in CFG.capacity_labels]))


@register("q_capacity_upsert", _upsert_sql(_FAN, oracles.CAPACITY, long_rows="capacity_long"))
def q_capacity_upsert(spark, sf):
    """O-55, O-10: capacity attributes inserted (NULL) then updated on the EAV table."""
    fx = fixtures(spark, sf, *_FAN)
    return _upsert(spark, sf, registry.capacity_long(fx["fx_registry"], fx["fx_element"], fx["fx_conduct"], CFG), [lab for _, lab in CFG.capacity_labels])


@register("q_registry_upsert", oracle_ctes(*_ALL, *_TABLES) + ", " + ", ".join(
    [oracles.REGISTRY, oracles.attached("registry_long", "fx_items", "told"), oracles.upsert("fx_values", "told", "told", "grown")]) + "\nFROM grown")
def q_registry_upsert(spark, sf):
    """O-56, O-10: the 22 registry attributes upserted on the EAV table (two areas of one item
    insert two rows)."""
    return _upsert(spark, sf, _registry_rows(spark, sf), registry.registry_labels(CFG))


# two buckets mapped onto fields that hold values already, one left unmatched (dropped silently)
CFG_BUCKETS = replace(CFG, bucket_labels=(("n_chamber_idle", "used_m"), ("n_duct", "has_pole"), ("n_rest", "nowhere")))


@register("q_bucket_upsert", _upsert_sql(_ELEMENTS, oracles.MARKED, oracles.BUCKETS, oracles.buckets_long("used_m", "has_pole", "nowhere"), long_rows="buckets_long"))
def q_bucket_upsert(spark, sf):
    """O-59, O-10: bucket attributes upserted on the EAV table."""
    fx = fixtures(spark, sf, *_ELEMENTS)
    return _upsert(spark, sf, registry.bucket_attributes(fx["fx_registry"], fx["fx_element"], CFG_BUCKETS), [lab for _, lab in CFG_BUCKETS.bucket_labels])
