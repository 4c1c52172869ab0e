"""Joins whose key is one value on a third of the rows."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tracksync.operators import links, registry, routing
from tracksync.operators.skew import hot_hashes, join_hot
from tracksync.sources.fixtures import FIXTURE_CONFIG as CFG


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _left(spark, n=30_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.concat(F.lit("v"), F.col("id") % 500))
    return spark.range(n).select(key.alias("k"), F.col("id").alias("a"))


def test_only_frequent_values_are_hot(spark):
    left = _left(spark)
    assert _rows(hot_hashes(left, "k", 0.05)) == _rows(spark.range(1).select(F.xxhash64(F.lit("hot"))))
    assert hot_hashes(left.filter("false"), "k", 0.05).count() == 0
    assert hot_hashes(spark.range(1000).select(F.col("id").alias("k")), "k", 0.05).count() == 0


def test_hot_join_equals_the_plain_join(spark):
    left = _left(spark)
    left = left.unionByName(left.limit(50))  # repeated rows stay repeated
    right = spark.createDataFrame([("hot", 1), ("hot", 1), ("v7", 2), (None, 3), ("none", 4)], "k string, b int")
    want = left.join(right, "k").select("k", "a", "b")
    assert _rows(join_hot(left, right, "k").select("k", "a", "b")) == _rows(want)
    for one, other in ((left.filter("false"), right), (left, right.filter("false"))):
        assert join_hot(one, other, "k").count() == 0


def test_no_task_holds_the_hot_value(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("-1", "false", "32"), strict=True):
        spark.conf.set(k, v)
    try:
        left, right = _left(spark), _left(spark).select("k").distinct().withColumn("b", F.lit(1))
        sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        plain, dealt = sizes(left.join(right, "k")), sizes(join_hot(left, right, "k"))
        assert sum(plain) == sum(dealt)
        assert max(plain) > 10_000 and max(dealt) < 4 * sorted(dealt)[len(dealt) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_links_tags_and_rerouting_under_a_hot_value(spark):
    # a third of the requests name dossier 1
    n = 600
    item = lambda i, kind, subject, project: (i, kind, subject, project)
    items = spark.createDataFrame([item(i, CFG.dossier_type, f"d{i}", 1) for i in range(20)]
                                  + [item(100 + i, CFG.request_type, "r", 2 + i % 2) for i in range(n)],
                                  "id long, type_id int, subject string, project_id int")
    named = {100 + i: 1 if i % 3 == 0 else i % 25 for i in range(n)}
    values = spark.createDataFrame([(CFG.entity_type, r, CFG.ref_field_id, f"d{d}") for r, d in named.items()],
                                   "customized_type string, customized_id long, custom_field_id int, value string")
    got = _rows(links.link_candidates(items, values, CFG).select("from_id", "to_id"))
    assert got == sorted((r, d) for r, d in named.items() if d < 20)

    projects = spark.createDataFrame([(1, None), (2, 7), (3, 8), (7, None), (8, None)], "id int, parent_id int")
    # dossier 1 by requests of project 3 (the named ones only), dossier 2 by a request that names another
    right = [(r, 1) for r, d in named.items() if d == 1 and r % 2 == 1]
    wrong = [(r, 2) for r, d in named.items() if d == 1]
    rel = spark.createDataFrame(right + wrong, "from_id long, to_id long")
    moved = routing.reroute_to_parent(items, values, rel, projects, CFG, flag_col="hit").filter("hit")
    assert _rows(moved.select("id", "project_id")) == [(1, 8)]

    el = spark.createDataFrame([(g, 0 if g % 3 == 0 else g % 40) for g in range(900)], "gid long, owner_id long")
    reg = spark.createDataFrame([(i, f"n{i}", CFG.operator_id if i < 30 else -1) for i in range(40)], "id long, num string, operator_id int")
    inside = el.filter("gid % 2 = 0").select(F.col("gid").alias("gid_element"), F.lit("box").alias("name"))
    tags = registry.area_tags(reg, el, inside, "area", CFG).groupBy("num", "attr", "value").count()
    want: dict = {}
    for g in range(0, 900, 2):
        owner = 0 if g % 3 == 0 else g % 40
        if owner < 30:
            want[(f"n{owner}", "area", "box")] = want.get((f"n{owner}", "area", "box"), 0) + 1
    assert {tuple(r)[:3]: r["count"] for r in tags.collect()} == want


def test_json_segments_of_a_hot_group_make_its_array(spark):
    n = 9_000
    # owner 0 holds a third of the elements, NULL kinds among them; three active owners share a group
    el = spark.range(n).select(F.col("id").alias("gid"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("owner_id"),
                               F.when(F.col("id") % 7 > 0, F.concat(F.lit('k"'), F.col("id"))).alias("kind"), F.lit(None).cast("string").alias("uso"))
    reg = spark.createDataFrame([(i, f"n{max(i, 2)}", CFG.operator_id if i < 30 else -1, "m", None) for i in range(40)],
                                "id long, num string, operator_id int, miga string, state string")
    whole = {r["num"]: (r["kinds"], r["usos"]) for r in registry.element_json_lists(reg, el, CFG).collect()}
    parts: dict = {}
    for r in registry.element_json_segments(reg, el, CFG, chunk=500).orderBy("segment").collect():
        assert len(json.loads(r["kinds"])) <= 500
        parts.setdefault(r["num"], []).append((r["kinds"][1:-1], r["usos"][1:-1]))
    assert len(parts["n2"]) == n // 500 and set(whole) == set(parts)
    for num, pieces in parts.items():
        assert whole[num] == tuple(f"[{','.join(p)}]" for p in zip(*pieces, strict=True))
    want = [None if g % 7 == 0 else f'k"{g}' for g in range(n) if (0 if g % 3 == 0 else g % 40) <= 2]
    assert json.loads(whole["n2"][0]) == want
    assert registry.element_json_segments(reg, el.filter("false"), CFG).count() == 0
