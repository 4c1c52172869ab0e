"""Every training-data query with a SQL oracle equals it (DuckDB) on the sf0.001 tables."""

from __future__ import annotations

import pytest
from conftest import SMALL
from test_oracle_parity import _key, _norm

from tracksync.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = duck.sql(ORACLES[name])
    assert sorted(res.columns) == cols
    idx = [res.columns.index(c) for c in cols]
    assert got == sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
