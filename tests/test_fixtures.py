"""The stand-in views give the same rows on Spark and on DuckDB (one SQL text each)."""

from __future__ import annotations

import pytest

from conftest import SMALL
from tracksync.sources.fixtures import FX_SQL, fixture, oracle_ctes


def _norm(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float):
        return round(v, 6)
    return None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(FX_SQL))
def test_view_equal_on_both_engines(spark, duck, name):
    df = fixture(spark, SMALL, name)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.sql(oracle_ctes(name) + f"SELECT {', '.join(cols)} FROM {name}")
    want = sorted((tuple(_norm(x) for x in r) for r in res.fetchall()), key=repr)
    assert got == want and len(got) > 0
