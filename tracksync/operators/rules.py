"""Value rules on the EAV table: decimal commas, recodes, due dates, presence classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..functions import add_days, decimal_comma_to_dot, format_day, recode
from . import eav


def decimal_commas(values: DataFrame, fields: DataFrame, cfg: SyncConfig,
                   flag_col: str | None = None) -> DataFrame:
    """O-57, O-27, O-47: ',' -> '.' in values of float-format fields (any entity type)."""
    floats = fields.filter(F.col("field_format") == F.lit(cfg.float_format)).select(
        F.col("id").alias("custom_field_id"), F.lit(True).alias("_is_float")).dropDuplicates(["custom_field_id"])
    j = values.join(floats, "custom_field_id", "left")
    j = j.select(*values.columns, "_is_float")
    out = eav.apply_rewrite(j, F.col("_is_float") & F.col("value").like("%,%"), decimal_comma_to_dot("value"), flag_col)
    return out.drop("_is_float")


def recode_flags(values: DataFrame, cfg: SyncConfig, flag_col: str | None = None) -> DataFrame:
    """O-58, O-48: exact recode of one field's values (any entity type)."""
    keys = [k for k, _ in cfg.recode_map]
    where = (F.col("custom_field_id") == F.lit(cfg.recode_field_id)) & F.col("value").isin(keys)
    return eav.apply_rewrite(values, where, recode("value", cfg.recode_map), flag_col)


def due_dates(values: DataFrame, fields: DataFrame, state_days: DataFrame, cfg: SyncConfig) -> DataFrame:
    """O-62, O-31, O-46, O-45: (customized_id, due_date) from the current state.

    The state field's value names another field; that field's value is the base
    date; the state's day offset (lookup table) is added; NULL offset -> NULL date.
    """
    state = values.filter(F.col("custom_field_id") == F.lit(cfg.state_field_id)).select(
        "customized_id", F.col("value").alias("state_name"))
    by_name = fields.select(F.col("id").alias("custom_field_id"), F.col("name").alias("state_name"))
    named = state.join(by_name, "state_name")
    # only fields whose name is a state of the lookup can hold a base date
    base_rows = eav.of_fields(values, eav.fields_labelled(fields, state_days.select(F.col("state").alias("attr"))))
    base = (named.join(base_rows.select("customized_id", "custom_field_id", "value"), ["customized_id", "custom_field_id"])
            .select("customized_id", "state_name", F.col("value").cast("date").alias("base_date")))
    days = state_days.select(F.col("state").alias("state_name"), "add_days")
    return base.join(days, "state_name").select(
        "customized_id", format_day(add_days("base_date", "add_days")).alias("due_date"))


def apply_due_dates(values: DataFrame, fields: DataFrame, state_days: DataFrame, cfg: SyncConfig,
                    flag_col: str | None = None) -> DataFrame:
    """Write the due dates into the rows of the field(s) labelled ``cfg.due_label``.

    The label resolves to field ids on the dictionary (a bounded lookup, instead of
    a cross join with a one-row relation); the update is keyed by item and only the
    rows of those fields take part in the join.
    """
    target = due_dates(values, fields, state_days, cfg).select("customized_id", F.col("due_date").alias("new_value"))
    return eav.apply_update(values, target, keys=["customized_id"], flag_col=flag_col,
                            field_ids=eav.fields_labelled(fields, [cfg.due_label]))


def presence_codes(items: DataFrame, values: DataFrame, cfg: SyncConfig) -> DataFrame:
    """(id, code) for every dossier from the presence of two probe fields.

    A row with a NULL value counts as absent; duplicates reduce to "any non-NULL".
    """
    a, b = cfg.probe_a_field_id, cfg.probe_b_field_id
    probes = (values.filter((F.col("customized_type") == F.lit(cfg.entity_type))
                            & F.col("custom_field_id").isin([a, b]))
              .groupBy(F.col("customized_id").alias("id"))
              .agg(F.max((F.col("custom_field_id") == F.lit(a)) & F.col("value").isNotNull()).alias("has_a"),
                   F.max((F.col("custom_field_id") == F.lit(b)) & F.col("value").isNotNull()).alias("has_b")))
    d = items.filter(F.col("type_id") == F.lit(cfg.dossier_type)).select("id").join(probes, "id", "left")
    ha, hb = F.coalesce(F.col("has_a"), F.lit(False)), F.coalesce(F.col("has_b"), F.lit(False))
    code = (F.when(ha & ~hb, F.lit(cfg.code_only_a)).when(hb & ~ha, F.lit(cfg.code_only_b))
            .when(~ha & ~hb, F.lit(cfg.code_none)).otherwise(F.lit(cfg.code_both)))
    return d.select("id", code.alias("code"))


def presence_source(items: DataFrame, values: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Update source (customized_id, custom_field_id, new_value) of the classification field."""
    return presence_codes(items, values, cfg).select(
        F.col("id").alias("customized_id"), F.lit(cfg.class_field_id).alias("custom_field_id"),
        F.col("code").alias("new_value"))


def classify_presence(items: DataFrame, values: DataFrame, cfg: SyncConfig,
                      flag_col: str | None = None) -> DataFrame:
    """O-66: write the presence code into each dossier's classification field row."""
    return eav.apply_update(values, presence_source(items, values, cfg), entity_type=cfg.entity_type,
                            flag_col=flag_col, field_ids=[cfg.class_field_id])

