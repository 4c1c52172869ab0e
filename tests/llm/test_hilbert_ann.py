from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tracksync.llm import hilbert_ann as H

SCHEMA = "vec_id long, embedding array<float>, rank int, keys string"


def exact(rows, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == len(rows[0][1]) and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    out = {}
    for q in good:
        if q % 20 == 0:
            scored = sorted((-float((good[q] * good[i]).sum()), i) for i in good if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)
    got: dict = {}
    for r in H.nearest(df, F.col("vec_id") % 20 == 0, **how).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for found in got.values():
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
    return {q: [(i, s) for _, i, s in f] for q, f in got.items()}


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = H.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_one_block_is_exact_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 5).astype(float).tolist()) for i in range(150)]
    rows += [(1000, None), (1001, [0.0] * 5), (1002, [1.0, None, 1.0, 1.0, 1.0]), (1003, [float("nan")] * 5), (1004, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (1005, [1.0] * 4), (None, [1.0] * 5)]
    rows += [(2000 + i, [1.0, 1.0, 1.0, 1.0, 1.0]) for i in range(50)]
    want = exact(rows, 20)
    assert run(spark, rows + [rows[7]] * 3) == want
    few = [(0, [1.0, 2.0]), (1, [3.0, 4.0])]
    assert run(spark, few) == {0: [(1, 11.0)]}
    assert run(spark, []) == {} and run(spark, [(0, [0.0, 0.0])]) == {}


def test_recall_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 64)
    rng = np.random.default_rng(2)
    v = rng.standard_normal((2000, 32)).astype(np.float32)
    v[500:900] = v[500] + 0.01 * v[500:900]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    want, got = exact(rows, 20), run(spark, rows)
    assert got.keys() == want.keys() and all(len(f) == 20 for f in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    scores = {(q, i): s for q, f in got.items() for i, s in f}
    assert all(s == float((v[q].astype(float) * v[i].astype(float)).sum()) for (q, i), s in scores.items())


def test_recall_on_the_table(spark):
    from tracksync.llm.queries import QUERIES

    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = exact([(r[0], r[1]) for r in table], 20)
    got = QUERIES["op2_hilbert_ann"](spark, SMALL).collect()
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(found) == sum(map(len, want.values()))
    assert np.mean([(q, i) in found for q, f in want.items() for i, _ in f]) >= 0.9
