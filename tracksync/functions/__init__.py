"""Column-level building blocks (built-in Spark expressions only, no UDFs)."""

from .dates import add_days, format_day, run_timestamp
from .json import json_array_keep_nulls, is_object, name_of, parse_history, python_str, raw_or_self, value_text
from .predicates import ElementClasses, all_of, any_of, starts_with
from .text import clean_string_columns, clean_text, decimal_comma_to_dot, double_text, exact, recode, strip_word, with_suffix

__all__ = [
    "add_days", "format_day", "run_timestamp",
    "json_array_keep_nulls", "is_object", "name_of", "parse_history", "python_str", "raw_or_self", "value_text",
    "ElementClasses", "all_of", "any_of", "starts_with",
    "clean_string_columns", "clean_text", "decimal_comma_to_dot", "double_text", "exact", "recode", "strip_word", "with_suffix",
]
