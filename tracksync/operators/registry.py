"""Registry dossiers -> long (num, attr, value) attribute rows.

Inputs (column names):
  registry (id, num, operator_id, <attribute columns>)   -- one row per dossier
  element  (gid, owner_id, kind, note, uso)              -- 1:N children
  conduct  (owner_id, length_dm)                         -- 1:N children
  md       (id, owner_id)                                -- 1:N documents

Every count over a 1:N child is aggregated per owner *before* it meets the
registry, so the join is 1:1 and a dossier owning a third of all children costs a
partial aggregate, not a skewed join.  Counts are additive, so the per-owner
partials summed over the registry rows equal the counts over the joined rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..functions import ElementClasses
from ..functions.json import json_arrays_by_group, json_segments_by_group
from ..functions.text import as_text, exact
from .skew import join_hot

BUCKETS = ["n_chamber_used", "n_chamber_idle", "n_box", "n_cabinet", "n_pole", "n_duct", "n_rest"]


def active_registry(registry: DataFrame, cfg: SyncConfig) -> DataFrame:
    return registry.filter(F.col("operator_id") == F.lit(cfg.operator_id))


def element_counts_per_owner(element: DataFrame, cfg: SyncConfig) -> DataFrame:
    """One row per owner: the seven class buckets, total and POLE count (single pass)."""
    c = ElementClasses(cfg.vocab)
    return element.groupBy("owner_id").agg(
        F.count_if(c.cr_in_use()).alias("n_chamber_used"),
        F.count_if(c.cr_unused()).alias("n_chamber_idle"),
        F.count_if(c.arq()).alias("n_box"),
        F.count_if(c.arm()).alias("n_cabinet"),
        F.count_if(c.pole()).alias("n_pole"),
        F.count_if(c.canal()).alias("n_duct"),
        F.count_if(c.rest()).alias("n_rest"),
        F.count_if(c.cr()).alias("n_chamber"),
        F.count(F.lit(1)).alias("total"),
    )


def bucket_counts(registry: DataFrame, element: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-34: conditional counts grouped by (num, miga, state) over registry x element (inner)."""
    per_owner = element_counts_per_owner(element, cfg)
    reg = active_registry(registry, cfg).select("id", "num", "miga", "state")
    j = reg.join(per_owner, reg["id"] == per_owner["owner_id"])
    return j.groupBy("num", "miga", "state").agg(
        *[F.sum(b).cast("long").alias(b) for b in BUCKETS], F.sum("total").cast("long").alias("total"))


def _element_kinds(registry: DataFrame, element: DataFrame, cfg: SyncConfig) -> DataFrame:
    reg = active_registry(registry, cfg).select(F.col("id").alias("owner_id"), "num", "miga", "state")
    return join_hot(element.select("gid", "owner_id", "kind", "uso"), reg, "owner_id", among=element)


def element_json_lists(registry: DataFrame, element: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-37: ``json_agg(kind)``, ``json_agg(uso)`` per (num, miga, state), NULLs kept, ordered by gid.

    One text a group; :func:`element_json_segments` is the form for groups of any size.
    """
    return json_arrays_by_group(_element_kinds(registry, element, cfg), ["num", "miga", "state"],
                                [("kind", "kinds"), ("uso", "usos")], "gid")


def element_json_segments(registry: DataFrame, element: DataFrame, cfg: SyncConfig, chunk: int = 10_000) -> DataFrame:
    """O-37 in pieces: (num, miga, state, segment, kinds, usos), a segment for each ``chunk`` gids with an element."""
    return json_segments_by_group(_element_kinds(registry, element, cfg), ["num", "miga", "state"],
                                  [("kind", "kinds"), ("uso", "usos")], "gid", chunk)


def to_long(df: DataFrame, id_cols: Sequence[str], label_by_col: Sequence[tuple[str, str]],
            attr: str = "attr", value: str = "value") -> DataFrame:
    """Wide -> long in one scan (``Expand``); NULL values are kept; values become text."""
    cols = [as_text(df, c).alias(lab) for c, lab in label_by_col]
    wide = df.select(*[F.col(i) for i in id_cols], *cols)
    return wide.unpivot(list(id_cols), [exact(lab) for _, lab in label_by_col], attr, value)


def bucket_attributes(registry: DataFrame, element: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-59 source: the configured buckets as (num, attr, value)."""
    b = bucket_counts(registry, element, cfg)
    return to_long(b, ["num"], cfg.bucket_labels)


def class_counts_by_num(registry: DataFrame, element: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-35: single-bucket counts CR / ARQ / ARM / POLE grouped by num, as (num, attr, value)."""
    per_owner = element_counts_per_owner(element, cfg)
    reg = active_registry(registry, cfg).select("id", "num")
    j = reg.join(per_owner, reg["id"] == per_owner["owner_id"])
    src = {"cr": "n_chamber", "arq": "n_box", "arm": "n_cabinet", "pole": "n_pole"}
    agg = j.groupBy("num").agg(*[F.sum(src[k]).cast("long").alias(k) for k, _ in cfg.registry_class_labels])
    return to_long(agg, ["num"], cfg.registry_class_labels)


def tri_state(col: Column | str, cfg: SyncConfig) -> Column:
    """O-19: nullable boolean -> label with a default."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c == F.lit(True), F.lit(cfg.tri_true))
            .when(c == F.lit(False), F.lit(cfg.tri_false))
            .otherwise(F.lit(cfg.tri_null)))


def scalar_attributes(registry: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-41, O-20, O-19: plain casts plus the tri-state label, one scan, unpivoted (NULLs kept)."""
    reg = active_registry(registry, cfg)
    tri_label, tri_col = cfg.registry_tristate
    wide = reg.select("num", *[as_text(reg, c).alias(lab) for lab, c in cfg.registry_scalars],
                      tri_state(tri_col, cfg).alias(tri_label))
    labels = [lab for lab, _ in cfg.registry_scalars] + [tri_label]
    return wide.unpivot(["num"], [exact(lab) for lab in labels], "attr", "value")


def doc_counts(registry: DataFrame, md: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-24, O-33: ``COUNT(md.id)`` over registry LEFT JOIN md, grouped by num (zeros kept)."""
    per_owner = md.groupBy("owner_id").agg(F.count("id").alias("n"))
    reg = active_registry(registry, cfg).select("id", "num")
    j = reg.join(per_owner, reg["id"] == per_owner["owner_id"], "left")
    return j.groupBy("num").agg(F.sum(F.coalesce(F.col("n"), F.lit(0))).cast("long").alias("n_docs"))


def capacity(registry: DataFrame, element: DataFrame, conduct: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-23, O-33, O-36 (R5): registry x element x conduct fan-out counts without the fan-out.

    Per owner: n_elem, n_pole (elements), n_len (non-NULL lengths), conduct rows.
    COUNT(length) over the fan-out = sum(n_elem * n_len); "any POLE row" = sum(n_pole) > 0
    (an owner reaching the join has at least one conduct row).
    Output (num, installed, used, cable_count, has_pole).
    """
    c = ElementClasses(cfg.vocab)
    e = element.groupBy("owner_id").agg(F.count(F.lit(1)).alias("n_elem"), F.count_if(c.pole()).alias("n_pole"))
    k = conduct.groupBy("owner_id").agg(F.count("length_dm").alias("n_len"))
    reg = active_registry(registry, cfg).select("id", "num", "installed", "used")
    j = reg.join(e, reg["id"] == e["owner_id"]).drop("owner_id").join(k, reg["id"] == k["owner_id"])
    g = j.groupBy("num", "installed", "used").agg(
        F.sum(F.col("n_elem") * F.col("n_len")).cast("long").alias("cable_count"),
        F.sum("n_pole").alias("_poles"))
    return g.select("num", "installed", "used", "cable_count",
                    F.when(F.col("_poles") > 0, F.lit(cfg.pole_yes)).otherwise(F.lit(cfg.pole_no)).alias("has_pole"))


def capacity_long(registry: DataFrame, element: DataFrame, conduct: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-55 source: the four capacity attributes as (num, attr, value)."""
    return to_long(capacity(registry, element, conduct, cfg), ["num"], cfg.capacity_labels)


def area_tags(registry: DataFrame, element: DataFrame, point_areas: DataFrame, label: str,
              cfg: SyncConfig) -> DataFrame:
    """O-30 family: (num, attr=label, value=area name) for every element point inside an area (bag).

    One owner may hold a third of the elements, so owners meet the registry in a join that deals them.
    """
    reg = active_registry(registry, cfg).select(F.col("id").alias("owner_id"), "num")
    el = element.select("gid", "owner_id").join(point_areas, element["gid"] == point_areas["gid_element"])
    j = join_hot(el.select("gid", "owner_id", "name"), reg, "owner_id", among=element)
    return j.select("num", F.lit(label).alias("attr"), F.col("name").alias("value"))


def registry_attributes(registry: DataFrame, element: DataFrame, md: DataFrame,
                        point_area_layers: Sequence[tuple[str, DataFrame]],
                        cfg: SyncConfig) -> DataFrame:
    """O-56 source, O-40: the five attribute families, UNION ALL, as (num, attr, value)."""
    parts = [scalar_attributes(registry, cfg)]
    dc = doc_counts(registry, md, cfg)
    parts.append(dc.select("num", F.lit(cfg.registry_doc_count_label).alias("attr"),
                           F.col("n_docs").cast("string").alias("value")))
    for label, pa in point_area_layers:
        parts.append(area_tags(registry, element, pa, label, cfg))
    parts.append(class_counts_by_num(registry, element, cfg))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def registry_labels(cfg: SyncConfig) -> list[str]:
    """Every label :func:`registry_attributes` can emit."""
    out = [lab for lab, _ in cfg.registry_scalars] + [cfg.registry_tristate[0], cfg.registry_doc_count_label]
    out += list(cfg.registry_area_labels) + [lab for _, lab in cfg.registry_class_labels]
    return out


def attach_items(long_rows: DataFrame, items: DataFrame) -> DataFrame:
    """O-22: (num, attr, value) -> (item_id, attr, value) through ``subject = num``."""
    it = items.select(F.col("id").alias("item_id"), F.col("subject").alias("num"))
    return long_rows.join(it, "num").select("item_id", "attr", "value")
