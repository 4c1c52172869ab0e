"""Near duplicates of vectors: links, components and recall against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tests.conftest import SMALL
from tracksync.llm import pivot_index
from tracksync.llm.common import read_table
from tracksync.llm.pivot_index import far_apart, near_duplicates, op12_pivot_neardup


def brute(rows, at_least=0.95):
    """rows (id, vector) -> {(id, n_links, component_id)}, all usable and of one length; and the number of linked pairs."""
    v = np.array([r[1] for r in rows], np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    linked = v @ v.T >= at_least
    np.fill_diagonal(linked, False)
    ids = np.array([r[0] for r in rows])
    group = ids.copy()
    while True:
        after = np.minimum(group, np.where(linked, group[None, :], 1 << 60).min(axis=1))
        if (after == group).all():
            return {(int(i), int(n), int(g)) for i, n, g in zip(ids, linked.sum(axis=1), group, strict=True)}, int(linked.sum()) // 2
        group = after


def as_set(df):
    return {(r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect()}


def planted(seed=5, n=3000, dims=32):
    """Unit vectors, near copies at cosines on both sides of 0.95, one large dense group, exact copies."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dims))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [*base]
    for at, cosine in enumerate((0.94, 0.951, 0.96, 0.98, 0.99) * 60):
        g = rng.standard_normal(dims)
        g -= g @ base[at] * base[at]
        rows.append(cosine * base[at] + math.sqrt(1 - cosine**2) * g / np.linalg.norm(g))
    dense = base[700] + 0.02 * rng.standard_normal((500, dims))
    rows += [*dense, *([base[701]] * 400), *(3 * base[800:820])]
    return [(int(i), [float(x) for x in r]) for i, r in enumerate(rows)]


def test_links_of_planted_vectors(spark, monkeypatch):
    monkeypatch.setattr(pivot_index, "BLOCK", 64)  # the dense group fills many blocks
    rows = planted()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got, (want, pairs) = as_set(near_duplicates(df)), brute(rows)
    links = sum(g[1] for g in got) // 2
    assert links <= pairs and links >= 0.98 * pairs
    by_id = {g[0]: g for g in got}
    assert all(by_id[i][1] <= n for i, n, _ in want)  # no false link
    assert len(got & want) >= 0.99 * len(want)


def test_recall_just_above_the_threshold(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((2000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    g = rng.standard_normal((2000, 64))
    g -= (g * base).sum(axis=1, keepdims=True) * base
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    near = 0.952 * base + math.sqrt(1 - 0.952**2) * g
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).agg({"n_links": "sum"}).first()[0]
    assert got // 2 >= 0.95 * 2000


def test_query_on_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read_table(spark, SMALL, "embeddings").collect()]
    assert as_set(op12_pivot_neardup(spark, SMALL)) == brute(rows)[0]


def test_pivots_lie_apart():
    rng = np.random.default_rng(1)
    sample = np.concatenate([np.eye(8), np.eye(8)[:1] + 0.01 * rng.standard_normal((50, 8))])
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    assert len(far_apart(sample, 20)) <= 9 and far_apart(sample[:0], 5).shape == (0, 8)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], "x"), (2, [2.0, 0.0], "x"), (3, None, "x"), (4, [0.0, 0.0], "x"), (5, [nan, 1.0], "x"), (6, [inf, 1.0], "x"), (7, [None, 1.0], "x"), (8, [1.0], "x"), (9, [], "x"),
            (None, [1.0, 0.0], "x"), (None, None, "x"), (1, [1.0, 0.0], "x"), (12, [0.0, 1e300], "x"), (11, [0.0, 1e-300], "x"), (None, [1.0, 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, class string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()), key=str)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    want = [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (None, 3, 1, False), (11, 1, 11, True), (12, 1, 11, False), (None, 0, None, True), (None, 0, None, True), *alone]
    assert got == sorted(want, key=str)
    assert near_duplicates(df.limit(0)).collect() == []
    assert sorted(r["n_links"] for r in near_duplicates(df.filter("vec_id = 3")).collect()) == [0]
    with pytest.raises(Exception):
        near_duplicates(df.drop("embedding")).collect()
