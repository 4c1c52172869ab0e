from __future__ import annotations

import itertools
import random
import re

import pytest

from tracksync.llm import mixing
from tracksync.llm.mixing import emit_copies, mix_sources

SCHEMA = "doc_id long, text string, source string, size int, _row int, copies int"


def fill(sizes: dict, weights=(5, 2, 1), budget=1.5, cap=2.0) -> dict:
    """Water filling by rounds: share what is left among the open sources until none overflows."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, budget * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, 8, 9) for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_copies(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, "w " * rnd.randint(0, 40), rnd.choice(["a", "a", "a", "b", "c", "d", "é", None])) for i in range(400)]
    got = mix_sources(docs(spark, rows), cell_rows=16).select("_row.doc_id", "_row.source", "size", "source_size", "target", "copies").collect()
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want = fill(sizes)
    assert sorted(r["doc_id"] for r in got) == list(range(400))
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert all(abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) for r in own)
        assert max(r["copies"] for r in own) <= 2 and min(r["copies"] for r in own) >= 0
        assert max(r["copies"] for r in own) - min(r["copies"] for r in own) <= 1
        taken = sum(r["copies"] * r["size"] for r in own)
        assert abs(taken - want[s]) <= 2 * 40 + 0.1 * want[s]
        assert abs(sum(r["copies"] for r in own) - want[s] / max(1, sizes[s]) * len(own)) <= 1


def test_reruns_agree_over_any_partitioning(spark):
    rows = [(i, "w " * (i % 13), "abc"[i % 3]) for i in range(200)]
    one = mix_sources(docs(spark, rows).repartition(1)).select("_row.doc_id", "copies").collect()
    many = mix_sources(docs(spark, rows).repartition(7)).select("_row.doc_id", "copies").collect()
    assert sorted(one) == sorted(many)


def test_nulls_empties_repeats_and_extra_columns(spark):
    rows = [(1, None, None), (1, None, None), (None, "a b", "s"), (2, "", "s"), (2, "x " * 50_000, "s"), (3, " \t\n", "t")]
    df = docs(spark, rows)
    mixed = mix_sources(df)
    assert mixed.count() == len(rows)
    out = emit_copies(mixed, df.columns)
    assert out.columns == df.columns
    assert {r["size"] for r in out.collect()} <= {7}
    assert mix_sources(df.filter("false")).count() == 0


def test_repeated_ids_spread_over_cells(spark, monkeypatch):
    rows = [(None, f"w{i} x y", "s") for i in range(900)] + [(7, "a b c", "s")] * 500 + [(i, f"v{i} x y", "s") for i in range(100, 1000)]
    seen: list = []
    keep = mixing.materialise
    monkeypatch.setattr(mixing, "materialise", lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1])
    runs = []
    for parts in (1, 5):
        mixed = mix_sources(docs(spark, rows).repartition(parts), weights=(1,), budget=0.5, cell_rows=32)
        got = mixed.select("_row.doc_id", "_row.text", "copies").collect()
        assert len(got) == len(rows) and abs(sum(r["copies"] for r in got) - len(rows) / 2) <= 1
        runs.append(sorted((r["doc_id"] or 0, r["text"], r["copies"]) for r in got))
        cells = [f for n, f in seen if n == "mix-counts"][-1]
        assert max(r["_n"] for r in cells.collect()) <= 3 * 32
    assert runs[0] == runs[1]


def test_running_sums_over_ranges(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), i // 7, i % 7, rnd.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x int, y int, n long").repartition(3)
    got = mixing.running_sums(df, ["g"], [mixing.F.col("x"), mixing.F.col("y")], {"n": "before"}, "t").collect()
    seen: dict = {}
    want = []
    for g, x, y, n in sorted(rows, key=lambda r: r[1:3]):
        want.append((g, x, y, n, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + n
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert mixing.running_sums(df.filter("false"), [], [mixing.F.col("x")], {"n": "before"}, "t").count() == 0


def test_many_sources_reach_targets_without_one_task(spark):
    sizes = {f"s{i:04d}": 1 + i % 17 for i in range(600)} | {None: 5}
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = fill(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in sizes)
    plan = mixing.source_targets(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and re.search(r"Window \[.*\], \[_range#", plan)


def test_words_are_counted_in_the_first_step_alone(spark):
    mixed = mix_sources(docs(spark, [(i, "w " * i, "ab"[i % 2]) for i in range(50)]), carry=["doc_id"])
    assert "regexp_count" not in mixed._jdf.queryExecution().executedPlan().toString().lower()


def test_whole_rows_are_written_once_and_placed_by_small_columns(spark, monkeypatch):
    wide: list = []
    for step in ("materialise", "materialise_texts"):
        keep = getattr(mixing, step, None)
        monkeypatch.setattr(mixing, step, lambda df, name, keep=keep: wide.extend([name] * ("_row" in df.columns)) or keep(df, name), raising=False)
    rows = [(7, "a b c", "s")] * 60 + [(i, f"v{i} x y", "t") for i in range(60)]
    mixed = mix_sources(docs(spark, rows), cell_rows=8)
    assert wide == ["mix-sized"]
    lines = mixed._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = [i for i, line in enumerate(lines) if "Window [" in line]
    assert at
    for i in at:
        depth = lines[i].index("Window [")
        below = itertools.takewhile(lambda line: len(line) - len(line.lstrip(" :+-")) > depth, lines[i + 1:])
        assert not any("_row#" in line for line in below)
    assert sorted(r["_row"]["text"] for r in mixed.collect()) == sorted(t for _, t, _ in rows)
