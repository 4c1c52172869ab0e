"""Text rewrites, all built-in expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Printable ASCII is kept by the text hygiene rule.
NON_PRINTABLE_ASCII = r"[^\x20-\x7E]"


def clean_text(col: Column | str) -> Column:
    """Drop every character outside printable ASCII (accents included)."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, NON_PRINTABLE_ASCII, "")


def clean_string_columns(df: DataFrame) -> DataFrame:
    """Apply :func:`clean_text` to every string column in one ``select``; others pass through."""
    return df.select(*[
        clean_text(exact(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else exact(f.name)
        for f in df.schema.fields
    ])


def exact(name: str) -> Column:
    """Column reference by exact name (labels may hold spaces, dots or quotes)."""
    return F.col("`" + name.replace("`", "``") + "`")


def double_text(col: Column | str) -> Column:
    """Text of a double as the source database writes it: shortest digits, no trailing ``.0``,
    an exponent (at least two digits, signed) below 1e-4 and from 1e15 on."""
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    digits, size = c.cast("string"), F.abs(c)
    plain = F.regexp_replace(F.when(size < 1e15, digits).otherwise(F.lit("0")).try_cast("decimal(38,22)").cast("string"), r"\.?0+$", "")
    mantissa = F.regexp_replace(F.regexp_extract(digits, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(digits, r"E(-?[0-9]+)$", 1).try_cast("int")
    exponent = F.concat(mantissa, F.lit("e"), F.when(power < 0, F.lit("-")).otherwise(F.lit("+")), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    return (F.when(c.isNull(), F.lit(None).cast("string")).when(F.isnan(c), F.lit("NaN"))
            .when(size == F.lit(float("inf")), F.when(c > 0, F.lit("Infinity")).otherwise(F.lit("-Infinity")))
            .when(c == 0, F.when(digits.startswith("-"), F.lit("-0")).otherwise(F.lit("0")))
            .when((size >= 1e-4) & (size < 1e15), plain).otherwise(exponent))


def as_text(df: DataFrame, name: str) -> Column:
    """Cast to text; floating-point columns through :func:`double_text`."""
    return double_text(exact(name)) if isinstance(df.schema[name].dataType, T.DoubleType) else exact(name).cast("string")


def decimal_comma_to_dot(col: Column | str) -> Column:
    """Literal replace of every ',' by '.'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(c, F.lit(","), F.lit("."))


def recode(col: Column | str, mapping: tuple[tuple[str, str], ...]) -> Column:
    """Exact-match recode; values outside the mapping are returned unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for src, dst in mapping:
        out = (F.when(c == F.lit(src), F.lit(dst)) if out is None else out.when(c == F.lit(src), F.lit(dst)))
    return c if out is None else out.otherwise(c)


def strip_word(col: Column | str, word: str) -> Column:
    """Remove every occurrence of ``word`` with its surrounding blanks, case-insensitive."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"(?i)\s*" + _quote(word) + r"\s*", "")


def with_suffix(col: Column | str, suffix: str) -> Column:
    """``value || suffix``; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(c, F.lit(suffix))


def _quote(word: str) -> str:
    out = []
    for ch in word:
        out.append("\\" + ch if not ch.isalnum() and ch != " " else ch)
    return "".join(out)
