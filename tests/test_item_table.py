"""Items saved as shredded variants: same rows as from parsed maps, and scans that read the members in use alone."""

from __future__ import annotations

import json
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tracksync import __main__ as cli
from tracksync.operators import export
from tracksync.sources.fixtures import api_items, read_table
from tracksync.sources.item_table import SHREDDING, as_variant, read_items, save_items


VALUES = ["open", "true", True, False, None, 1, 2.5, "1", "", {"raw": "x"}, {"raw": None}, {"name": "n"}, [1, "a", None], [], "it's", 'q"']


def _frame(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "item string")


def _mixed():
    rows = [{"id": i, "subject": f"s{i}", "customField1": v} for i, v in enumerate(VALUES)]
    return rows + [{"id": 100, "subject": {"raw": "r"}}, {"id": 101, "subject": "s", "customField1": "open", "a.b": "dot", "it's": 1, 'q"\'?': 2}, {}]


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    return save_items(api_items(read_table(spark, SMALL, "orders")).select(F.col("item_json").alias("item")), str(tmp_path_factory.mktemp("items") / "t"))


def _members_read(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<item:(.*)>", plan)
    assert schemas, plan
    return schemas[0]


@pytest.mark.parametrize("wanted", [["open"], ["True"], ["true"], ["None"], [""], ["x"], ["1"], ["2.5"], ["[1, 'a', None]"], ["[]", "False"], ["it's", 'q"'], []])
def test_filter_like_parsed_maps(spark, tmp_path, wanted):
    text = _frame(spark, _mixed())
    maps = text.select(export.parse_items("item").alias("item"))
    table = read_items(spark, save_items(text, str(tmp_path / "t")))
    filters = {"customField1": wanted}
    ids = lambda df: sorted(str(r.id) for r in export.label_projection(export.filter_and(df, filters), {1: "one"}).collect())
    assert ids(table) == ids(maps)


def test_projection_like_parsed_maps_for_every_kind_of_value(spark, tmp_path):
    text = _frame(spark, _mixed())
    maps = text.select(export.parse_items("item").alias("item"))
    base = [(k, f"c{n}") for n, k in enumerate(["id", "subject", "status", "a.b", "it's", 'q"\'?', "nowhere"])]
    rows = lambda df: sorted(map(repr, export.label_projection(df, {1: "one", 2: "two"}, base=base).collect()))
    want = rows(maps)
    assert rows(as_variant(text)) == want
    assert rows(as_variant(maps)) == want
    assert rows(read_items(spark, save_items(maps, str(tmp_path / "t")))) == want


def test_a_filter_on_two_fields_reads_two_fields(spark, saved):
    items = read_items(spark, saved)
    kept = export.filter_and(items, {"customField1": ["F", "O"], "customField2": ["1-URGENT"]}).select(F.lit(1).alias("one"))
    read = _members_read(kept)
    assert read == "struct<0:variant,1:variant>"
    orders = read_table(spark, SMALL, "orders").filter("o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'")
    assert kept.count() == orders.count() > 0


def test_projection_reads_its_members_alone(spark, saved):
    out = export.label_projection(read_items(spark, saved), {3: "customer"}, base=[("id", "id")])
    assert _members_read(out).count("variant") == 2
    assert export.label_projection(read_items(spark, saved), {1: "status"}).count() == read_table(spark, SMALL, "orders").count()


def test_files_hold_typed_columns_and_settings_are_put_back(spark, tmp_path):
    import pyarrow.parquet as pq

    key = SHREDDING[0]
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        path = save_items(_frame(spark, [{"a": "x", "b": 1}] * 5).coalesce(1), str(tmp_path / "t"))
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, before)
    schema = str(pq.ParquetFile(next((tmp_path / "t").glob("*.parquet"))).schema)
    assert "typed_value (String)" in schema and "int64" in schema
    assert read_items(spark, path).count() == 5


def test_empty_tables_and_broken_text(spark, tmp_path):
    none = read_items(spark, save_items(_frame(spark, [{"a": 1}]).filter("false"), str(tmp_path / "t")))
    assert export.export_filtered(none, {"a": ["1"]}, {1: "one"}).count() == 0
    with pytest.raises(Exception, match="MALFORMED_RECORD|PARSE|malformed|Malformed"):
        save_items(spark.createDataFrame([("{ no",)], "item string"), str(tmp_path / "b"))
    with pytest.raises(TypeError):
        as_variant(spark.range(1).withColumnRenamed("id", "item"))


def test_command_line_saves_pages_and_exports_from_them(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    elements = [{"id": i, "subject": f"s{i}", "customField1": "x" if i % 2 else "y"} for i in range(6)]
    (tmp_path / "pages" / "page-1.json").write_text(json.dumps({"offset": 1, "_embedded": {"elements": elements}}))
    cli.cmd_save_items(spark, str(tmp_path / "pages"), str(tmp_path / "items"), 1000)
    args = ('{"customField1": ["x"]}', '{"1": "one"}')
    cli.cmd_export_filtered(spark, None, *args, str(tmp_path / "a"), "parquet", 1000, str(tmp_path / "items"))
    cli.cmd_export_filtered(spark, str(tmp_path / "pages"), *args, str(tmp_path / "b"), "parquet", 1000)
    a, b = (sorted(map(tuple, spark.read.parquet(str(tmp_path / d)).collect())) for d in "ab")
    assert a == b and [r[0] for r in a] == ["1", "3", "5"]
