"""The EAV table in buckets: steps write the buckets of their fields and nothing else."""

from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tracksync.plans import publish, q_sync, sync
from tracksync.plans.eav_store import BUCKETS, EavTable

COLUMNS = ["id", "customized_type", "customized_id", "custom_field_id", "value"]


@pytest.fixture
def values(spark):
    rows = [(i, "Item", i % 50, f, f"v{i}") for i, f in enumerate([100 + k % 40 for k in range(400)])] + [(400, "Item", 1, None, "no field")]
    return spark.createDataFrame(rows, "id long, customized_type string, customized_id long, custom_field_id int, value string")


def files(root) -> dict[str, str]:
    return {str(p.relative_to(root)): hashlib.md5(p.read_bytes()).hexdigest() for p in Path(root).rglob("*.parquet")}


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_round_trip_and_pruned_read(spark, values, tmp_path):
    table = EavTable.create(values, str(tmp_path))
    assert rows(table.read()) == rows(values)
    some = table.read([105])
    assert rows(some.filter("custom_field_id = 105")) == rows(values.filter("custom_field_id = 105"))
    assert len(some.inputFiles()) < len(table.read().inputFiles())
    assert table.read().schema == values.schema


def test_a_step_leaves_other_buckets_alone(spark, values, tmp_path):
    table = EavTable.create(values, str(tmp_path))
    before = files(tmp_path)
    new = spark.createDataFrame([(900, "Item", 7, 105, None)], values.schema)
    after = table.replaced([105, 106], lambda t: t.withColumn("value", F.lit("x")).unionByName(new))
    now = files(tmp_path)
    assert {k: now[k] for k in before} == before  # no file of an earlier state is written again
    touched = set(table.buckets([105, 106]))
    assert {b for b in range(BUCKETS) if table.versions.get(b) != after.versions.get(b)} == touched
    assert {int(k.split("bucket=")[1].split("/")[0]) for k in now.keys() - before.keys()} == touched
    want = values.withColumn("value", F.when(F.col("custom_field_id").isin(105, 106), F.lit("x")).otherwise(F.col("value"))).unionByName(new)
    assert rows(after.read()) == rows(want) and rows(table.read()) == rows(values)


def test_failed_and_careless_steps_change_nothing(spark, values, tmp_path):
    table = EavTable.create(values, str(tmp_path))
    with pytest.raises(Exception):
        table.replaced([105], lambda t: t.withColumn("value", F.raise_error(F.lit("no")).cast("string")))
    stray = next(f for f in range(100, 140) if table.buckets([f]) != table.buckets([105]))
    with pytest.raises(ValueError, match="does not name"):
        table.replaced([105], lambda t: t.withColumn("custom_field_id", F.lit(stray)))
    assert rows(table.read()) == rows(values)


def test_emptied_bucket_and_empty_table(spark, values, tmp_path):
    table = EavTable.create(values, str(tmp_path / "a"))
    bucket = table.buckets([105])[0]
    held = [f for f in range(100, 140) if table.buckets([f]) == [bucket]]
    gone = table.replaced(held, lambda t: t.filter("custom_field_id IS NULL"))
    assert gone.read().filter(F.col("custom_field_id").isin(held)).count() == 0
    none = EavTable.create(values.limit(0), str(tmp_path / "b"))
    assert none.versions == {} and none.read().count() == 0
    assert rows(none.replaced([105], lambda t: t.unionByName(values.filter("custom_field_id = 105"))).read()) == rows(values.filter("custom_field_id = 105"))


def test_a_field_with_most_rows_becomes_many_files(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 12).selectExpr("id", "'Item' AS customized_type", "id AS customized_id", "CAST(105 AS int) AS custom_field_id", "sha2(CAST(id AS string), 256) AS value")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        table = EavTable.create(df, str(tmp_path))
    finally:
        spark.conf.unset(key)
    sizes = [p.stat().st_size for p in Path(tmp_path).rglob("*.parquet")]
    assert len(sizes) > 4 and table.read().count() == 200_000


def test_publishing_writes_no_rows(spark, values, tmp_path):
    root = str(tmp_path / "out")
    table = EavTable.create(values, f"{root}/_values")
    publish.publish(spark, {"values": table, "items": values.select("id")}, root)
    held = publish.current_parts(spark, root, "values")
    assert held.versions == table.versions and publish.current_parts(spark, root, "items") is None
    assert rows(publish.read_current(spark, root, "values")) == rows(values)
    again = held.replaced([105], lambda t: t.limit(0))
    # not yet published: readers see the last committed state
    assert publish.current_parts(spark, root, "values").versions == table.versions != again.versions
    publish.publish(spark, {"values": again}, root)
    assert publish.read_current(spark, root, "values").filter("custom_field_id = 105").count() == 0


def test_rows_stream_to_their_buckets_without_a_sort(spark, values, tmp_path, monkeypatch):
    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: seen.append(int(spark.conf.get(key))) or write(self, *a, **k))
    table = EavTable.create(values, str(tmp_path / "a"))
    assert seen == [BUCKETS] and spark.conf.get(key) == before
    assert rows(table.read()) == rows(values)
    with pytest.raises(Exception, match="no number"):
        EavTable.create(values.withColumn("value", F.raise_error(F.lit("no number")).cast("string")), str(tmp_path / "b"))
    assert spark.conf.get(key) == before


def test_sources_read_twice_are_written_and_not_cached(spark, tmp_path, monkeypatch):
    class Enough(Exception):
        pass

    def log(step, seconds):
        if step == "q04_q05_capacity":
            raise Enough

    tables = {
        "nation": ["id n_nationkey", "concat('NATION_', id) n_name"], "part": ["id p_partkey"], "lineitem": ["id l_suppkey", "1 l_linenumber", "double(id) l_quantity"],
        "customer": ["id c_custkey", "concat('Customer#', id) c_name", "id % 25 c_nationkey", "1.5D c_acctbal", "'M' c_mktsegment"],
        "orders": ["id o_orderkey", "id % 20 o_custkey", "'F' o_orderstatus", "2.5D o_totalprice"], "events": ["id event_id", "'click' event_type", "timestamp_ntz'2024-01-01 00:00:11' ts"]}
    for name, columns in tables.items():
        spark.range(40).selectExpr(*columns).write.parquet(str(tmp_path / f"{name}.parquet"))
    cached, cuts, frame, cut = [], [], type(spark.range(0)), sync._cut
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: cached.append(self.columns) or persist(self, *a))
    monkeypatch.setattr(sync, "_cut", lambda df, name: cuts.append(name) or cut(df, name))
    with pytest.raises(Enough):
        sync.run_sync(q_sync.inputs(spark, str(tmp_path)), q_sync.CFG, q_sync.RUN_TS, log=log)
    spark.catalog.clearCache()
    assert cached == [["id", "subject"]]
    assert {"entries", "capacity"} <= set(cuts)
