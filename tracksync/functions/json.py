"""JSON helpers: typed parse of state histories, NULL-keeping JSON arrays,
scalar-or-object coalescing and Python-style stringification of raw JSON values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def history_schema(state_key: str, date_key: str) -> str:
    return f"array<struct<`{state_key}`: string, `{date_key}`: string>>"


def parse_history(col: Column | str, state_key: str, date_key: str, strict: bool = True) -> Column:
    """JSON array of {state, date} objects -> ``array<struct>``.

    NULL text gives NULL; broken JSON gives NULL, or fails the job when ``strict``.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, history_schema(state_key, date_key), {"mode": "FAILFAST"} if strict else {})


def json_array_keep_nulls(value: Column | str, order_by: Column | str) -> Column:
    """``json_agg(value ORDER BY order_by)`` that keeps NULL elements.

    ``collect_list`` drops NULLs, so each value travels inside a struct, which is
    never NULL; the list is sorted by the key and unwrapped before ``to_json``.
    """
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order_by) if isinstance(order_by, str) else order_by
    items = F.array_sort(F.collect_list(F.struct(o.alias("k"), v.alias("v"))))
    return F.to_json(F.transform(items, lambda r: r["v"]))


def json_segments_by_group(df: DataFrame, group_cols: Sequence[str], values: Sequence[tuple[str, str]],
                           order_col: str, chunk: int = 10_000) -> DataFrame:
    """``json_agg(value ORDER BY order_col)`` per group in ordered pieces: (group, segment, arrays), NULLs kept.

    A segment is the JSON array of one range of ``order_col`` of width ``chunk``; the arrays of a group one
    after another, by segment, hold its elements in order.  Where the integer order key is unique, a row holds at
    most ``chunk`` elements and no task holds a group, however large.  ``values`` lists (column, output name).
    """
    part = F.floor(F.col(order_col) / F.lit(chunk)).alias("segment")
    return df.groupBy(*group_cols, part).agg(*[json_array_keep_nulls(c, order_col).alias(name) for c, name in values])


def json_arrays_by_group(df: DataFrame, group_cols: Sequence[str], values: Sequence[tuple[str, str]],
                         order_col: str, chunk: int = 10_000) -> DataFrame:
    """Several ``json_agg(value ORDER BY order_col)`` per group, NULLs kept, each one text.

    Joins the segments of :func:`json_segments_by_group` in their order; ``chunk`` never changes the
    result.  A text is a whole group by definition; large groups are better read as segments.
    """
    def inner(name: str) -> Column:
        # '[a,b]' -> 'a,b' ; each segment holds at least one element
        return F.expr(f"substring(`{name}`, 2, length(`{name}`) - 2)")

    segments = json_segments_by_group(df, group_cols, values, order_col, chunk)
    merged = segments.groupBy(*group_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col("segment"), *[inner(n).alias(n) for _, n in values]))).alias("_p"))

    def joined(name: str) -> Column:
        return F.concat(F.lit("["), F.array_join(F.transform("_p", lambda p: p[name]), ","), F.lit("]"))

    return merged.select(*group_cols, *[joined(n).alias(n) for _, n in values])


def value_text(v: Column | str) -> Column:
    """Text of a JSON value (variant): strings as they are, objects and lists as JSON, JSON null as NULL."""
    return F.variant_get(F.col(v) if isinstance(v, str) else v, "$", "string")


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def raw_or_self(v: Column | str) -> Column:
    """A field that is either text or an object ``{"raw": text}``: return the text."""
    c = F.col(v) if isinstance(v, str) else v
    return F.when(is_object(c), F.variant_get(c, "$.raw", "string")).otherwise(value_text(c))


def name_of(v: Column | str) -> Column:
    """``obj.name`` of a link object; NULL when absent."""
    c = F.col(v) if isinstance(v, str) else v
    return F.when(is_object(c), F.variant_get(c, "$.name", "string"))


def python_str(v: Column) -> Column:
    """Python ``str()`` of a JSON value (variant).

    An object yields its ``raw`` member or ''; JSON null is 'None', a boolean 'True' or
    'False', a text itself (also the text "true"); a list prints its items as Python does,
    items that are lists or objects as JSON.  Missing keys are handled by the caller.
    """
    def scalar(x: Column, kind: Column, quote: bool) -> Column:
        text = value_text(x)
        quoted = F.when(text.contains("'") & ~text.contains('"'), F.concat(F.lit('"'), text, F.lit('"'))) \
            .otherwise(F.concat(F.lit("'"), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'")))
        return (F.when(F.is_variant_null(x), F.lit("None"))
                .when(kind == F.lit("BOOLEAN"), F.initcap(text))
                .when(kind == F.lit("STRING"), quoted if quote else text).otherwise(text))

    kind = F.schema_of_variant(v)
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: scalar(x, F.schema_of_variant(x), True))
    return (F.when(is_object(v), F.coalesce(F.variant_get(v, "$.raw", "string"), F.lit("")))
            .when(kind.startswith("ARRAY"), F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))
            .otherwise(scalar(v, kind, False)))
