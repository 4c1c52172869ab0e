"""Exports: AND-of-INs filter over API items, label projection, JSON widening, hygiene, writers.

API items are rows with one ``map<string,variant>`` or ``variant`` column (default ``item``): each
JSON member with its type.  The key set is open (custom fields appear and disappear), so no
struct.  Parsed pages are maps; items saved by ``sources.item_table`` are variants, of which a scan reads
the members in use alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from ..functions import all_of, clean_string_columns, is_object, name_of, python_str, raw_or_self, value_text
from ..session import scratch_path
from . import eav


def _variant_member(item: Column, key: str) -> Column:
    """A member of a variant object with its type: SQL NULL where it is missing, a JSON null where it is null."""
    for quote in "'\"":
        # a path that the scan can prune by; it has no escapes
        if re.fullmatch(rf"[^{quote}?]+", key):
            return F.variant_get(item, f"$[{quote}{key}{quote}]", "variant")
    return F.variant_get(item, "$", "map<string,variant>")[key]


def _members(items: DataFrame, item_col: str) -> Callable[[str], Column]:
    item = F.col(item_col)
    if isinstance(items.schema[item_col].dataType, VariantType):
        return lambda key: _variant_member(item, key)
    return lambda key: item[key]


def _is_wanted(present: Column, value: Column, expected: Sequence[object]) -> Column:
    wanted = [str(v) for v in expected]
    return F.when(present, python_str(value)).otherwise(F.lit("")).isin(wanted) if wanted else F.lit(False)


def filter_and(items: DataFrame, filters: Mapping[str, Sequence[object]], item_col: str = "item") -> DataFrame:
    """O-14: keep items whose every filtered field, stringified as Python would, is in its list.

    Missing key -> '' ; object -> its ``raw`` member or '' ; JSON null -> 'None';
    booleans -> 'True' / 'False'.  An empty filter map keeps all; an empty list keeps none.

    The predicate reads a parsed map many times; it is bound once as a lambda variable
    (``exists(array(item), m -> ...)``), so that pushing the filter below the projection that
    parses the item copies the parse once and not into every reference.  Of a variant it asks for each
    member by its path, so that a scan of saved items reads the filtered members and no others.
    """
    if isinstance(items.schema[item_col].dataType, VariantType):
        member = _members(items, item_col)
        return items.filter(all_of([_is_wanted(member(f).isNotNull(), member(f), expected) for f, expected in filters.items()]))

    def keep(m: Column) -> Column:
        return all_of([_is_wanted(F.map_contains_key(m, F.lit(f)), m[f], expected) for f, expected in filters.items()])

    return items.filter(F.exists(F.array(F.col(item_col)), keep))


def label_projection(items: DataFrame, labels: Mapping[int, str], item_col: str = "item",
                     key_format: str = "customField{}", base: Sequence[tuple[str, str]] = (
                         ("id", "id"), ("subject", "subject"), ("status", "status"), ("type", "type")),
                     strict: bool = False) -> DataFrame:
    """O-16, O-17: one ``select``: id, subject (text or ``{raw}``), status / type names, then
    one column per labelled custom field (missing key -> NULL).

    ``strict``: a subject object without ``raw`` fails the job (as the original export
    did) instead of giving NULL.
    """
    member = _members(items, item_col)
    out: list[Column] = []
    for key, name in base:
        if key == "subject":
            subject = raw_or_self(member(key))
            if strict:
                missing_raw = is_object(member(key)) & F.variant_get(member(key), "$.raw", "string").isNull()
                subject = F.when(missing_raw, F.raise_error(F.lit("subject object without 'raw'"))) \
                    .otherwise(subject)
            out.append(subject.alias(name))
        elif key in ("status", "type"):
            out.append(name_of(member(key)).alias(name))
        else:
            out.append(value_text(member(key)).alias(name))
    out += [value_text(member(key_format.format(n))).alias(label) for n, label in labels.items()]
    return items.select(*out)


def parse_items(json: Column | str) -> Column:
    """JSON object text -> ``map<string,variant>``; broken text fails the job."""
    return F.from_json(json, "map<string,variant>", {"mode": "FAILFAST"})


def json_keys(df: DataFrame, json_col: str, strict: bool = True) -> list[str]:
    """O-42: the keys of all JSON objects of a column, each once, in order of name.

    The distinct keys are found by a partial (map-side) aggregate; what reaches the driver is one
    name for each column of the widened table, however many rows and whatever their key sets.
    """
    how = {"mode": "FAILFAST"} if strict else {}
    keys = df.select(F.explode(F.map_keys(F.from_json(F.col(json_col), "map<string,string>", how))).alias("key"))
    return [r["key"] for r in keys.distinct().orderBy("key").collect()]


def widen_json(df: DataFrame, json_col: str, keep: Sequence[str], keys: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """O-42: JSON object text -> one column per key (missing key -> NULL).

    ``keys`` in the order given, or all keys that occur (:func:`json_keys`, which reads ``df`` once more).
    """
    how = {"mode": "FAILFAST"} if strict else {}
    keys = json_keys(df, json_col, strict) if keys is None else keys
    parsed = df.select(*keep, F.from_json(F.col(json_col), "map<string,string>", how).alias("_m"))
    return parsed.select(*keep, *[F.col("_m")[k].alias(k) for k in keys])


def field_names(fields: DataFrame) -> list[str]:
    """Names of the dictionary, sorted: the columns of the pivoted export."""
    return sorted(r[0] for r in fields.select("name").distinct().collect() if r[0] is not None)


def export_view(items: DataFrame, values: DataFrame, fields: DataFrame, entity_type: str | None) -> DataFrame:
    """(subject, custom_fields) of every item: its custom fields as one JSON object, NULL if it has none."""
    objects = eav.json_object_per_item(values, fields, entity_type=entity_type)
    return items.select(F.col("id").alias("customized_id"), "subject").join(objects, "customized_id", "left").select("subject", "custom_fields")


def export_all(items: DataFrame, values: DataFrame, fields: DataFrame, entity_type: str | None) -> DataFrame:
    """O-70: subject of every item + one text-cleaned column per custom field, in order of name: every
    key that occurs, and every field of the dictionary (an empty column if no item has it).

    The JSON view (O-43) is written once to the shared scratch folder, as both the union of its keys and the
    widening (O-42) read it; hygiene (O-50) comes last.
    """
    view = export_view(items, values, fields, entity_type)
    path = scratch_path(view.sparkSession, "export-view")
    view.write.parquet(path)
    view = view.sparkSession.read.schema(view.schema).parquet(path)
    keys = sorted({*json_keys(view, "custom_fields"), *field_names(fields)})
    return clean_string_columns(widen_json(view, "custom_fields", ["subject"], keys))


def export_pivot(items: DataFrame, values: DataFrame, fields: DataFrame, entity_type: str | None,
                 names: Sequence[str] | None = None) -> DataFrame:
    """The export without the JSON view: one text-cleaned column per dictionary field, by one pivot."""
    names = field_names(fields) if names is None else list(names)
    wide = eav.pivot_wide(values, fields, names, entity_type=entity_type)
    joined = items.select(F.col("id").alias("customized_id"), "subject").join(wide, "customized_id", "left")
    return clean_string_columns(joined.drop("customized_id"))


def export_filtered(items: DataFrame, filters: Mapping[str, Sequence[object]], labels: Mapping[int, str],
                    item_col: str = "item") -> DataFrame:
    """O-69: filter, then project labels.  Emptiness is the caller's ``isEmpty()`` check."""
    return label_projection(filter_and(items, filters, item_col), labels, item_col)


class NothingFound(LookupError):
    """The filtered export matched no item (the service answered "not found")."""


def require_rows(df: DataFrame) -> DataFrame:
    """O-69: raise :class:`NothingFound` when ``df`` is empty (reads at most one row)."""
    if df.isEmpty():
        raise NothingFound("no items match the filters")
    return df


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """O-13: tabular export with a header row and no index column."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
