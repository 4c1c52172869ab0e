"""Entity-attribute-value core.

Tables (column names):
  values  (id, customized_type, customized_id, custom_field_id, value)
  fields  (id, name, field_format)                  -- a small dictionary
  datos   (item_id, attr, value)                    -- long source rows, attr = a field label

Rules kept from the original job:
  * inserts are a bag: no DISTINCT, NOT EXISTS is tested against the table as it
    was before the statement (``distinct_keys=True`` for a set);
  * an insert writes NULL, the update then fills it (upsert);
  * an update with several matching source rows takes the smallest non-NULL
    value (``min``); "matched with NULL" is kept apart from "not matched" by a
    hit flag, so a matched NULL overwrites;
  * updates do not check the entity type unless ``entity_type`` is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ids import IdSequence

VALUE_COLUMNS = ["id", "customized_type", "customized_id", "custom_field_id", "value"]
KEYS = ["customized_id", "custom_field_id"]


def field_lookup(fields: DataFrame, label_col: str = "attr") -> DataFrame:
    """(field_id, <label_col>) from the dictionary."""
    f = fields.select(F.col("id").alias("field_id"), F.col("name").alias(label_col))
    return f


def resolve_labels(datos: DataFrame, fields: DataFrame, label_col: str = "attr") -> DataFrame:
    """Inner join on label = field name; unknown labels drop silently (see :func:`unmatched_labels`)."""
    return datos.join(field_lookup(fields, label_col), label_col, "inner")


Fields = DataFrame | Sequence[int]


def fields_labelled(fields: DataFrame, labels: DataFrame | Sequence[str]) -> DataFrame:
    """(custom_field_id) of the dictionary fields that carry one of ``labels`` (a list, or a frame with ``attr``)."""
    named = (fields.filter(F.col("name").isin(list(labels))) if not isinstance(labels, DataFrame)
             else fields.join(labels.select(F.col("attr").alias("name")).distinct(), "name", "left_semi"))
    return named.select(F.col("id").alias("custom_field_id")).distinct()


def of_fields(values: DataFrame, fields: Fields) -> DataFrame:
    """Rows of the given fields: a semi join with the dictionary, or the few ids of the configuration."""
    if isinstance(fields, DataFrame):
        return values.join(fields.select("custom_field_id"), "custom_field_id", "left_semi").select(*values.columns)
    return values.filter(F.col("custom_field_id").isin(list(fields)))


def not_of_fields(values: DataFrame, fields: Fields) -> DataFrame:
    if isinstance(fields, DataFrame):
        return values.join(fields.select("custom_field_id"), "custom_field_id", "left_anti").select(*values.columns)
    return values.filter(~F.coalesce(F.col("custom_field_id").isin(list(fields)), F.lit(False)))


def unmatched_labels(datos: DataFrame, fields: DataFrame, label_col: str = "attr") -> DataFrame:
    """Labels of ``datos`` that no field carries: the rows the inner resolve drops."""
    names = fields.select(F.col("name").alias(label_col))
    return datos.select(label_col).distinct().join(names, label_col, "left_anti")


def missing_rows(datos: DataFrame, fields: DataFrame, values: DataFrame, *, entity_type: str,
                 item_col: str = "item_id", label_col: str = "attr", distinct_keys: bool = False, field_ids: Fields | None = None) -> DataFrame:
    """Rows to append: (item, field) pairs of ``datos`` with no row of ``entity_type`` yet.

    Output (customized_type, customized_id, custom_field_id, value=NULL), without ids.
    ``field_ids`` (the fields ``datos`` can resolve to) restricts the existing rows that
    the anti join shuffles.
    """
    cand = resolve_labels(datos.select(F.col(item_col).alias("customized_id"), label_col), fields, label_col)
    cand = cand.select("customized_id", F.col("field_id").alias("custom_field_id"))
    existing = values.filter(F.col("customized_type") == F.lit(entity_type))
    if field_ids is not None:
        existing = of_fields(existing, field_ids)
    existing = existing.select(*KEYS)
    new = cand.join(existing, KEYS, "left_anti")
    if distinct_keys:
        new = new.dropDuplicates(KEYS)
    return new.select(
        F.lit(entity_type).alias("customized_type"),
        "customized_id",
        "custom_field_id",
        F.lit(None).cast("string").alias("value"),
    )


def append_with_ids(values: DataFrame, new_rows: DataFrame, seq: IdSequence | None = None) -> DataFrame:
    """Append rows after giving them fresh ids above ``max(values.id)`` (unique, dense per call).

    Pass the run's :class:`IdSequence` to avoid rescanning ``values`` for its maximum.
    """
    seq = seq or IdSequence.from_table(values, "id")
    return values.unionByName(seq.assign(new_rows, "id").select(*VALUE_COLUMNS))


def source_by_label(datos: DataFrame, fields: DataFrame, *, item_col: str = "item_id", label_col: str = "attr",
                    value_col: str = "value") -> DataFrame:
    """Update source keyed by (customized_id, custom_field_id) through the dictionary."""
    r = resolve_labels(datos.select(F.col(item_col).alias("customized_id"), label_col,
                                    F.col(value_col).alias("new_value")), fields, label_col)
    return r.select("customized_id", F.col("field_id").alias("custom_field_id"), "new_value")


def apply_update(values: DataFrame, source: DataFrame, *, keys: Sequence[str] = KEYS,
                 entity_type: str | None = None, flag_col: str | None = None,
                 value_col: str = "value", new_col: str = "new_value", where=None,
                 field_ids: Fields | None = None, changed_col: str | None = None) -> DataFrame:
    """``UPDATE values SET value = s.new FROM source s WHERE keys match``, deterministic.

    The source is first reduced to one row per key (smallest non-NULL value, with a
    hit flag), so the join can never multiply target rows.  ``where`` restricts the
    target rows (e.g. only empty values); ``changed_col`` flags rows whose value
    actually changes (NULL-safe).  The reduction is a
    partial (map-side) aggregate, which also absorbs hot keys before the shuffle.

    ``field_ids``: the only fields the update can touch.  Rows of other fields skip
    the join (no shuffle) and are unioned back unchanged, so a step moves the rows of
    its fields, not the whole EAV table.
    """
    if field_ids is not None:
        touched = apply_update(of_fields(values, field_ids), source, keys=keys, entity_type=entity_type,
                               flag_col=flag_col, value_col=value_col, new_col=new_col, where=where,
                               changed_col=changed_col)
        rest = not_of_fields(values, field_ids)
        for c in (flag_col, changed_col):
            if c:
                rest = rest.withColumn(c, F.lit(False))
        return touched.unionByName(rest)
    red = source.groupBy(*keys).agg(F.min(new_col).alias("_new"), F.max(F.lit(True)).alias("_hit"))
    joined = values.join(red, list(keys), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if entity_type is not None:
        hit = hit & (F.col("customized_type") == F.lit(entity_type))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    cols = [F.when(hit, F.col("_new")).otherwise(F.col(c)).alias(c) if c == value_col else F.col(c)
            for c in values.columns]
    if flag_col:
        cols.append(hit.alias(flag_col))
    if changed_col:
        cols.append((hit & ~F.col(value_col).eqNullSafe(F.col("_new"))).alias(changed_col))
    return joined.select(*cols)


def apply_rewrite(values: DataFrame, where, new_value, flag_col: str | None = None, value_col: str = "value") -> DataFrame:
    """In-place rewrite of ``value`` on rows matching ``where`` (a narrow, shuffle-free update)."""
    hit = F.coalesce(where, F.lit(False))
    cols = [F.when(hit, new_value).otherwise(F.col(c)).alias(c) if c == value_col else F.col(c) for c in values.columns]
    if flag_col:
        cols.append(hit.alias(flag_col))
    return values.select(*cols)


def upsert(values: DataFrame, fields: DataFrame, insert_datos: DataFrame, update_datos: DataFrame, *,
           entity_type: str, guard_updates: bool = False, distinct_keys: bool = False, flag_col: str | None = None,
           seq: IdSequence | None = None, field_ids: Fields | None = None) -> DataFrame:
    """Insert missing (item, field) rows with NULL, then update from ``update_datos``.

    ``insert_datos`` and ``update_datos`` are (item_id, attr, value) frames; they are
    the same frame in most steps, and differ for the history sync (all entries vs
    the latest per state).
    """
    labels = (insert_datos if insert_datos is update_datos
              else insert_datos.select("attr").unionByName(update_datos.select("attr")))
    ids = field_ids if field_ids is not None else fields_labelled(fields, labels)
    new = missing_rows(insert_datos, fields, values, entity_type=entity_type,
                       distinct_keys=distinct_keys, field_ids=ids)
    grown = append_with_ids(values, new, seq)
    src = source_by_label(update_datos, fields)
    return apply_update(grown, src, entity_type=entity_type if guard_updates else None, flag_col=flag_col,
                        field_ids=ids)


def split_by_fields(values: DataFrame, fields: Fields) -> tuple[DataFrame, DataFrame]:
    """(rows of ``fields``, all other rows)."""
    return of_fields(values, fields), not_of_fields(values, fields)


def pivot_wide(values: DataFrame, fields: DataFrame, names: Sequence[str], *, entity_type: str | None) -> DataFrame:
    """EAV -> one row per item, one column per named field (duplicates: smallest value)."""
    v = values if entity_type is None else values.filter(F.col("customized_type") == F.lit(entity_type))
    f = fields.filter(F.col("name").isin(list(names))).select(
        F.col("id").alias("custom_field_id"), "name")
    return (v.join(f, "custom_field_id")
            .groupBy("customized_id").pivot("name", list(names)).agg(F.min("value")))


def json_object_per_item(values: DataFrame, fields: DataFrame, *, entity_type: str | None) -> DataFrame:
    """EAV -> (customized_id, custom_fields JSON object {field name: value}).

    One entry per name (smallest value); keys sorted; NULL values kept as JSON null.
    A row holds at most one entry per dictionary field, so it is bounded by the dictionary.
    """
    v = values if entity_type is None else values.filter(F.col("customized_type") == F.lit(entity_type))
    f = fields.select(F.col("id").alias("custom_field_id"), "name")
    one = v.join(f, "custom_field_id").groupBy("customized_id", "name").agg(F.min("value").alias("value"))
    return one.groupBy("customized_id").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value"))))).alias("custom_fields"))
