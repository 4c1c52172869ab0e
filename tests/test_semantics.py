
from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

import naive
from tracksync.operators import eav, export, history, links, registry, rules
from tracksync.operators.ids import IdSequence, dense_index
from tracksync.sources.fixtures import FIXTURE_CONFIG as CFG

VSCHEMA = "id long, customized_type string, customized_id long, custom_field_id int, value string"
FSCHEMA = "id int, name string, field_format string"


def _fields(spark):
    return spark.createDataFrame([(1, "a", "date"), (2, "b", "float"), (3, "c", "list")], FSCHEMA)


def test_latest_per_state_null_first_and_window_equal(spark):
    ts = dt.datetime
    e = spark.createDataFrame(
        [(1, "s", ts(2024, 1, 2)), (1, "s", ts(2024, 1, 5)), (1, "t", ts(2023, 1, 1)), (1, "t", None),
         (2, "s", ts(2022, 3, 4))], "item_id long, state string, state_ts timestamp_ntz")
    agg = {tuple(r) for r in history.latest_per_state(e).collect()}
    win = {tuple(r) for r in naive.latest_per_state_window(e).collect()}
    assert agg == win == {(1, "s", "2024-01-05"), (1, "t", None), (2, "s", "2022-03-04")}


def test_history_explode_drops_null_and_empty(spark):
    items = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id long, subject string")
    h = spark.createDataFrame(
        [("A", '[{"estado":"x","fecha":"2024-01-01 00:00:00"},{"estado":"y","fecha":null}]'), ("B", "[]"),
         ("C", None)], "num string, hist string")
    rows = sorted(tuple(r) for r in history.history_entries(items, h, CFG).collect())
    assert rows == [(1, "x", dt.datetime(2024, 1, 1)), (1, "y", None)]


def test_insert_is_a_bag_and_checks_entity_type(spark):
    values = spark.createDataFrame([(10, "Project", 1, 1, "v")], VSCHEMA)
    datos = spark.createDataFrame([(1, "a", None), (1, "a", None), (1, "zz", None)],
                                  "item_id long, attr string, value string")
    bag = eav.missing_rows(datos, _fields(spark), values, entity_type="WorkPackage")
    assert bag.count() == 2  # repeated, and the Project row of the same id does not block
    dist = eav.missing_rows(datos, _fields(spark), values, entity_type="WorkPackage", distinct_keys=True)
    assert dist.count() == 1
    assert [r.attr for r in eav.unmatched_labels(datos, _fields(spark)).collect()] == ["zz"]


def test_update_min_rule_hit_flag_and_row_count(spark):
    values = spark.createDataFrame(
        [(1, "WorkPackage", 1, 1, "old"), (2, "WorkPackage", 2, 1, "old"), (3, "Project", 1, 1, "old"),
         (4, "WorkPackage", 3, 1, "keep")], VSCHEMA)
    src = spark.createDataFrame([(1, 1, "z"), (1, 1, "b"), (2, 1, None)],
                                "customized_id long, custom_field_id int, new_value string")
    out = eav.apply_update(values, src)
    got = {r.id: r.value for r in out.collect()}
    assert out.count() == 4
    assert got == {1: "b", 2: None, 3: "b", 4: "keep"}  # min wins, matched NULL overwrites, no type guard
    guarded = {r.id: r.value for r in eav.apply_update(values, src, entity_type="WorkPackage").collect()}
    assert guarded[3] == "old"


def test_buckets_follow_three_valued_logic(spark):
    reg = spark.createDataFrame([(1, "N1", 1, "m", "s")], "id long, num string, operator_id int, miga string, state string")
    el = spark.createDataFrame(
        [(1, 1, "OTROS", None, "2"), (2, 1, "Poste", "x", "0"), (3, 1, None, None, None), (4, 1, "cr-9", "", None)],
        "gid long, owner_id long, kind string, note string, uso string")
    b = registry.bucket_counts(reg, el, CFG).first().asDict()
    # 'OTROS' with NULL note: in no bucket (NOT(NULL) is NULL), still in the total
    assert b["total"] == 4
    assert b["n_box"] == 0 and b["n_rest"] == 0
    assert b["n_pole"] == 1 and b["n_duct"] == 1
    # CR with NULL uso: neither uso <> '0' nor uso = '0'
    assert b["n_chamber_used"] == 0 and b["n_chamber_idle"] == 0


def test_capacity_fast_equals_naive(spark):
    reg = spark.createDataFrame([(i, str(i % 4), 1, float(i), i % 3) for i in range(12)],
                                "id long, num string, operator_id int, installed double, used int")
    el = spark.createDataFrame([(g, g % 7, "POSTE" if g % 5 == 0 else ("x" if g % 3 else None))
                                for g in range(40)], "gid long, owner_id long, kind string")
    co = spark.createDataFrame([(o % 9, None if o % 4 == 0 else 1.0) for o in range(30)],
                               "owner_id long, length_dm double")
    fast = {tuple(r) for r in registry.capacity(reg, el, co, CFG).collect()}
    slow = {tuple(r) for r in naive.capacity_naive(reg, el, co, CFG).collect()}
    assert fast == slow and len(fast) > 0


def test_symmetric_anti_join_equals_or_form(spark):
    pairs = spark.createDataFrame([(1, 2), (3, 4), (5, 6), (7, 7)], "from_id long, to_id long")
    edges = spark.createDataFrame([(2, 1), (3, 4), (7, 7)], "from_id long, to_id long")
    got = sorted(tuple(r) for r in links.symmetric_anti_join(pairs, edges).collect())
    p, e = pairs.alias("p"), edges.alias("e")
    cond = (((F.col("e.from_id") == F.col("p.from_id")) & (F.col("e.to_id") == F.col("p.to_id")))
            | ((F.col("e.from_id") == F.col("p.to_id")) & (F.col("e.to_id") == F.col("p.from_id"))))
    want = sorted(tuple(r) for r in p.join(e, cond, "left_anti").collect())
    assert got == want == [(5, 6)]


def test_filter_and_stringification(spark):
    rows = [('{"a":"x","d":{"raw":"r"},"n":null,"b":true,"i":3,"l":["u",1,null,true]}',), ('{"a":"y","d":{"x":1},"b":"true","n":"None"}',)]
    items = spark.createDataFrame(rows, "j string").select(export.parse_items(F.col("j")).alias("item"))

    def n(f):
        return export.filter_and(items, f).count()

    assert n({}) == 2
    assert n({"a": []}) == 0
    assert n({"missing": [""]}) == 2
    assert n({"d": ["r"]}) == 1 and n({"d": [""]}) == 1
    assert n({"n": ["None"]}) == 2
    # the text "true" is not the boolean
    assert n({"b": [True]}) == n({"b": ["True"]}) == 1 and n({"b": ["true"]}) == 1
    assert n({"l": ["['u', 1, None, True]"]}) == 1
    assert n({"i": [3], "a": ["x"]}) == 1


def test_clean_text_strips_non_ascii(spark):
    from tracksync.functions import clean_text

    df = spark.createDataFrame([("Cañón\u0002 ok",)], "t string")
    assert df.select(clean_text("t")).first()[0] == "Can ok"


def test_clean_columns_and_export_take_dotted_labels(spark):
    from tracksync.functions import clean_string_columns

    df = spark.createDataFrame([("é1", 2)], "`nº. a` string, `b.c` int")
    assert clean_string_columns(df).collect() == [("1", 2)]
    items = spark.createDataFrame([(1, "s"), (2, "t")], "id long, subject string")
    fields = spark.createDataFrame([(1, "nº. a", "x"), (2, "b", "x")], FSCHEMA)
    values = spark.createDataFrame([(1, "WorkPackage", 1, 1, "v\u00e9")], VSCHEMA)
    for by in (export.export_all, export.export_pivot):
        out = by(items, values, fields, "WorkPackage")
        assert out.columns == ["subject", "b", "nº. a"]
        assert sorted(map(tuple, out.collect())) == [("s", None, "v"), ("t", None, None)]


def test_key_union_of_json_objects(spark):
    rows = [(1, '{"b": 1, "a.x": "t", "Ü": null}'), (2, '{"c": {"d": [1]}}'), (3, "{}"), (4, None), (5, '{"b": true}')]
    df = spark.createDataFrame(rows, "id long, j string")
    assert export.json_keys(df, "j") == ["a.x", "b", "c", "Ü"]
    out = export.widen_json(df, "j", ["id"])
    assert out.columns == ["id", "a.x", "b", "c", "Ü"]
    assert sorted(map(tuple, out.collect())) == [(1, "t", "1", None, None), (2, None, None, '{"d":[1]}', None), (3, *[None] * 4), (4, *[None] * 4), (5, None, "true", None, None)]
    assert export.widen_json(df.limit(0), "j", ["id"]).columns == ["id"]
    many = spark.range(3000).select("id", F.to_json(F.create_map(F.concat(F.lit("k"), (F.col("id") % 700).cast("string")), F.lit("v"))).alias("j"))
    assert len(export.json_keys(many, "j")) == 700  # no cap
    with pytest.raises(Exception):
        export.json_keys(spark.createDataFrame([("{broken",)], "j string"), "j")


def test_doubles_as_the_source_database_writes_them(spark):
    from tracksync.functions import double_text

    want = {1.0: "1", 12345678.5: "12345678.5", 0.1: "0.1", -2.50: "-2.5", 1e-5: "1e-05", 1e15: "1e+15", 123456789012345.0: "123456789012345",
            0.0: "0", 1.5e300: "1.5e+300", 0.0001: "0.0001", 100.0: "100", float("inf"): "Infinity"}
    df = spark.createDataFrame([(k,) for k in want] + [(None,)], "x double").select("x", double_text("x").alias("t"))
    got = {repr(r.x): r.t for r in df.collect()}
    assert got == {**{repr(float(k)): v for k, v in want.items()}, "None": None, "0.0": "0"}


def test_every_sync_step_changes_rows(spark):
    from conftest import SMALL
    from tracksync.plans import q_sync

    fx = q_sync.inputs(spark, SMALL)
    names = {r.name for r in fx.fields.collect()}
    from tracksync.plans.q_core import configured_labels

    assert set(configured_labels(CFG)) <= names


def test_dense_index_is_dense_and_unique(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "x")
    out, n = dense_index(df, "i", start=5)
    ids = sorted(r.i for r in out.collect())
    assert n == 1000 and ids == list(range(5, 1005))
    seq = IdSequence(100)
    a = seq.assign(spark.range(3).withColumnRenamed("id", "x"), "id")
    b = seq.assign(spark.range(2).withColumnRenamed("id", "x"), "id")
    assert sorted(r.id for r in a.collect()) == [100, 101, 102]
    assert sorted(r.id for r in b.collect()) == [103, 104]


def test_due_date_with_null_days_and_fractional(spark):
    values = spark.createDataFrame(
        [(1, "WorkPackage", 7, 136, "a"), (2, "WorkPackage", 7, 1, "2024-01-30"), (3, "WorkPackage", 7, 87, None),
         (4, "WorkPackage", 8, 136, "c"), (5, "WorkPackage", 8, 3, "2024-01-01"), (6, "WorkPackage", 8, 87, None)],
        VSCHEMA)
    fields = spark.createDataFrame([(1, "a", "date"), (3, "c", "date"), (87, "due_date", "date")], FSCHEMA)
    days = spark.createDataFrame([("a", 2.5), ("c", None)], "state string, add_days double")
    got = {r.customized_id: r.due_date for r in rules.due_dates(values, fields, days, CFG).collect()}
    assert got == {7: "2024-02-01", 8: None}
    upd = {r.id: r.value for r in rules.apply_due_dates(values, fields, days, CFG).collect()}
    assert upd[3] == "2024-02-01" and upd[6] is None and upd[2] == "2024-01-30"


def test_presence_codes_both_set_gives_58(spark):
    items = spark.createDataFrame([(1, 8), (2, 8), (3, 8), (4, 8), (5, 9)], "id long, type_id int")
    values = spark.createDataFrame(
        [(1, "WorkPackage", 1, 85, "x"), (2, "WorkPackage", 2, 10, "y"), (3, "WorkPackage", 3, 85, None),
         (4, "WorkPackage", 4, 85, "x"), (5, "WorkPackage", 4, 10, "y")], VSCHEMA)
    got = {r.id: r.code for r in rules.presence_codes(items, values, CFG).collect()}
    assert got == {1: "57", 2: "56", 3: "93", 4: "58"}


def test_second_run_seeds_no_items(spark):
    from conftest import SMALL
    from tracksync.plans import q_sync
    from tracksync.plans.sync import run_sync

    inp = q_sync.inputs(spark, SMALL)
    first = run_sync(inp, CFG, q_sync.RUN_TS)
    n_items = first["items"].count()
    assert n_items > inp.items.count()
    again = first
    for _ in range(2):  # a second run, and a third on top
        before, again = again, run_sync(dataclasses.replace(inp, **again), CFG, q_sync.RUN_TS)
        assert again["items"].count() == n_items
        # the EAV table only grows by rows the run before could not see yet, never shrinks
        assert again["values"].count() >= before["values"].count()


def test_json_arrays_by_group_chunked_equals_single_pass(spark):
    import json as _json

    from tracksync.functions.json import json_arrays_by_group

    rows = [(g % 3, g, None if g % 4 == 0 else f"k{g}") for g in range(0, 60)]
    df = spark.createDataFrame(rows, "grp int, gid long, kind string")
    got = {r.grp: _json.loads(r.kinds) for r in json_arrays_by_group(df, ["grp"], [("kind", "kinds")], "gid",
                                                                      chunk=7).collect()}
    want = {k: [v for (g2, _, v) in sorted(rows, key=lambda r: r[1]) if g2 == k] for k in range(3)}
    assert got == want


def test_strict_json_fails_on_broken_history(spark):
    from dataclasses import replace

    import pytest

    items = spark.createDataFrame([(1, "A")], "id long, subject string")
    h = spark.createDataFrame([("A", '[{"estado":"x"')], "num string, hist string")
    assert history.history_entries(items, h, replace(CFG, strict_json=False)).count() == 0
    with pytest.raises(Exception):
        history.history_entries(items, h, CFG).collect()


def test_label_projection_subject_forms_and_strict(spark):
    import pytest

    rows = [('{"id":1,"subject":"plain"}',), ('{"id":2,"subject":{"raw":"r"}}',), ('{"id":4,"subject":"{brace"}',)]
    items = spark.createDataFrame(rows, "j string").select(export.parse_items(F.col("j")).alias("item"))
    got = sorted(r.subject for r in export.label_projection(items, {}, strict=True).collect())
    assert got == ["plain", "r", "{brace"]
    bad = spark.createDataFrame([('{"id":3,"subject":{"x":1}}',)], "j string").select(
        export.parse_items(F.col("j")).alias("item"))
    assert export.label_projection(bad, {}).first().subject is None
    with pytest.raises(Exception):
        export.label_projection(bad, {}, strict=True).collect()
