from __future__ import annotations

import zlib

import pytest

from tests.conftest import SMALL
from tracksync.llm import sharding
from tracksync.llm.common import read_table
from tracksync.llm.sharding import assign_shards, op1_sharding, write_shards

SCHEMA = "doc_id long, text string, size int, shard string, _row int"


def check(rows, got, shards):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    per: dict = {}
    for r in got:
        per.setdefault(r["shard"], []).append(r)
    assert set(per) <= set(range(shards))
    total, largest = sum(r["size"] for r in got), max((r["size"] for r in got), default=0)
    for s in range(shards):
        own = per.get(s, [])
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= largest + 1e-6
    key = lambda r: -1 << 63 if r["doc_id"] is None else r["doc_id"]
    line = [key(r) for s in sorted(per) for r in sorted(per[s], key=lambda r: r["slot"])]
    assert line == sorted(line)


def run(spark, rows, shards):
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA)
    return assign_shards(df, shards).select("_row_cols.doc_id", "size", "text_crc32", "shard", "slot").collect()


@pytest.mark.parametrize("shards", [1, 5])
def test_sizes_are_near_equal_and_slots_gapless(spark, shards):
    rows = [(i * i % 9973, "é" * (i % 37)) for i in range(600)]
    check(rows, run(spark, rows, shards), shards)


def test_one_key_holds_most_rows(spark):
    rows = [(7, "abc")] * 500 + [(i, "d" * 20) for i in range(100)] + [(None, None), (None, "")]
    got = run(spark, rows, 4)
    assert len(got) == len(rows)
    per = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert max(per) - min(per) <= 2 * 28


def test_long_text_empty_table_and_files(spark, tmp_path):
    rows = [(1, "x" * 1_000_000), (2, "y"), (2, "y")]
    check(rows, run(spark, rows, 3), 3)
    assert run(spark, [], 3) == []
    df = spark.createDataFrame([(i, "t" * i, 1, "x", 2) for i in range(50)], SCHEMA)
    write_shards(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 4


def test_light_repeated_key_is_cut_until_no_range_is_overfull(spark, monkeypatch):
    rows = [(None, None)] * 2000 + [(i, "z" * 1000) for i in range(200)]
    seen: list = []
    keep = sharding.materialise
    monkeypatch.setattr(sharding, "materialise", lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1])
    check(rows, run(spark, rows, 1), 1)
    last = [f for n, f in seen if n == "shard-ranges"][-1]
    assert max(r["_n"] for r in last.collect()) <= sharding.OVERFULL * len(rows) / 8


@pytest.mark.parametrize("hot", [(1 << 60) + 1, (1 << 63) - 1, -(1 << 63), -(1 << 63) + 1, None])
def test_hot_keys_of_any_size(spark, monkeypatch, hot):
    """A third of all rows share one key, light or none in text; its neighbours lie one apart."""
    rows = [(hot, None)] * 700 + [(i, "z" * 100) for i in range(600)] + [(None, None)] * 700
    if hot is not None:
        rows += [(k, "n") for k in (hot - 1, hot + 1) if -(1 << 63) <= k < 1 << 63]
    seen: list = []
    keep = sharding.materialise
    monkeypatch.setattr(sharding, "materialise", lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1])
    got = run(spark, rows, 3)
    line = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert line == sorted(line) and len(got) == len(rows)
    last = [f for n, f in seen if n == "shard-ranges"][-1]
    assert max(r["_n"] for r in last.collect()) <= sharding.OVERFULL * len(rows) / 24 and sum(n == "shard-ranges" for n, _ in seen) < 8


def test_query_on_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = op1_sharding(spark, SMALL).collect()
    check(rows, got, 24)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
