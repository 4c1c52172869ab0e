"""Property tests on random small frames (hypothesis): rewrites equal their naive forms."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import naive
from tracksync.operators import eav, registry
from tracksync.sources.fixtures import FIXTURE_CONFIG as CFG

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

kinds = st.sampled_from(["POSTE 9", "cr", "Arq", None, "x", "OTROS"])


@SETTINGS
@given(reg=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3), st.integers(0, 2)), min_size=1, max_size=8),
       el=st.lists(st.tuples(st.integers(0, 6), kinds), max_size=25),
       co=st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.floats(0, 9))), max_size=25))
def test_capacity_pre_aggregated_equals_fan_out(spark, reg, el, co):
    r = spark.createDataFrame([(i, str(n), op, float(i), i % 2) for i, (_, n, op) in enumerate(reg)],
                              "id long, num string, operator_id int, installed double, used int")
    e = spark.createDataFrame([(g, o, k) for g, (o, k) in enumerate(el)] or [(0, -1, None)],
                              "gid long, owner_id long, kind string")
    c = spark.createDataFrame([(o, v) for o, v in co] or [(-1, None)], "owner_id long, length_dm double")
    fast = sorted(tuple(x) for x in registry.capacity(r, e, c, CFG).collect())
    slow = sorted(tuple(x) for x in naive.capacity_naive(r, e, c, CFG).collect())
    assert fast == slow


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 4), st.integers(1, 3), st.one_of(st.none(), st.text("ab", max_size=2))),
                     min_size=1, max_size=15),
       src=st.lists(st.tuples(st.integers(0, 5), st.integers(1, 3), st.one_of(st.none(), st.text("ab", max_size=2))),
                    max_size=15),
       restrict=st.booleans())
def test_update_keeps_row_count_and_uses_min(spark, vals, src, restrict):
    v = spark.createDataFrame([(i, "WorkPackage", c, f, x) for i, (c, f, x) in enumerate(vals)],
                              "id long, customized_type string, customized_id long, custom_field_id int, value string")
    s = spark.createDataFrame(src or [(-1, 1, None)], "customized_id long, custom_field_id int, new_value string")
    out = eav.apply_update(v, s, field_ids=[1, 2] if restrict else None)
    got = {r.id: r.value for r in out.collect()}
    assert len(got) == len(vals) == out.count()
    for i, (c, f, x) in enumerate(vals):
        hits = [y for (c2, f2, y) in src if (c2, f2) == (c, f)]
        if restrict and f not in (1, 2):
            hits = []
        if hits:
            nn = [y for y in hits if y is not None]
            assert got[i] == (min(nn) if nn else None)
        else:
            assert got[i] == x
