"""Whitening: against numpy in whole numbers and doubles, on the table and on small frames."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from tests.conftest import SMALL
from tracksync.llm.common import read_table
from tracksync.llm.whitening import numbered, op11_whitening, whiten


def brute(vectors):
    """x of each vector; n, S of the distinct ones; deviations; covariance of exactly centred entries."""
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(r) for r in x})
    n, dims = len(fit), len(fit[0])
    s = [sum(r[d] for r in fit) for d in range(dims)]
    centre = lambda r: np.array([float(a - Fraction(b, n)) for a, b in zip(r, s, strict=True)])
    held = np.array([centre(r) for r in fit])
    return n, [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x], np.array([centre(r) for r in x]), held.T @ held / n


def check(rows, vectors, ids, components=16):
    n, deviation, centred, v = brute(vectors)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    want = centred @ axes / np.sqrt(values)
    at = {i: k for k, i in enumerate(ids)}
    assert len(rows) == len(ids) * len(values)
    sign = {}
    for r in rows:
        k, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[k] and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(values[c] / np.trace(v), rel=1e-9)
        if abs(want[k, c]) > 1e-3:
            sign.setdefault(c, np.sign(want[k, c]) * np.sign(r["whitened"]))
        assert r["whitened"] * sign.get(c, 1) == pytest.approx(want[k, c], abs=1e-6)
    whitened = np.zeros((len(ids), len(values)))
    for r in rows:
        whitened[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    return whitened


def test_query_on_the_table(spark):
    table = [(r["vec_id"], r["embedding"]) for r in read_table(spark, SMALL, "embeddings").collect()]
    rows = op11_whitening(spark, SMALL).collect()
    whitened = check(rows, [v for _, v in table], [i for i, _ in table])
    assert np.abs(np.cov(whitened.T, bias=True) - np.eye(16)).max() < 1e-4


def test_repeated_vectors_count_once(spark):
    rng = np.random.default_rng(2)
    vectors = [v.tolist() for v in rng.standard_normal((60, 5))]
    vectors += [vectors[0]] * 40 + [[c + 1e-9 for c in vectors[1]]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(5)
    got = whiten(df, components=3).selectExpr("vec_id", "n", "deviation", "identity_error", "explained", "posexplode(whitened) AS (at, whitened)") \
        .selectExpr("vec_id", "n", "CAST(deviation AS long) deviation", "identity_error", "explained[at] explained", "at + 1 AS component", "whitened").collect()
    check(got, vectors, range(len(vectors)), 3)
    assert got[0]["n"] in (60, 61)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "r"), (2, [3.0, 1.0], "r"), (2, [3.0, 1.0], "r"), (None, [0.5, 0.25], "r"), (3, None, "r"), (4, [nan, 1.0], "r"), (5, [1.0, -inf], "r"), (6, [None, 1.0], "r"),
            (7, [], "r"), (8, [1.0], "r"), (9, [1e300, 1.0], "r")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string")
    got = whiten(df).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"]) for r in got if r["vec_id"]) == [(False, 1), (False, 2), (False, 2)] and len(got) == 4
    assert {r["n"] for r in got} == {3} and all(len(r["whitened"]) == 2 and r["identity_error"] < 1e-9 for r in got)
    one = whiten(df.filter("vec_id = 1")).collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, [None, None], None, 0.0)]
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], "vec_id long, embedding array<double>")
    assert all(r["whitened"][0] is not None and r["whitened"][1:] == [None, None] for r in whiten(line).collect())
    for none in (df.limit(0), df.filter("vec_id IN (3, 4)")):
        assert whiten(none).collect() == []
    huge = spark.createDataFrame([(1, [2.0**50, 0.0]), (2, [-(2.0**50), 1.0])], "vec_id long, embedding array<double>")
    assert {int(r["deviation"]) for r in whiten(huge).collect()} == {(2 * 2**56) ** 2 + 64**2}


def test_numbers_are_gapless(spark):
    df = spark.range(1000).repartition(7)
    assert sorted(r["row"] for r in numbered(df, "row").collect()) == list(range(1000))
