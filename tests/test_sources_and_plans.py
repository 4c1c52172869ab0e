"""Saved pages, JDBC options, atomic publish, spatial join and plan-shape tests."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tracksync.operators import links, registry, spatial
from tracksync.plans import publish
from tracksync.sources import jdbc, pages
from tracksync.sources.fixtures import FIXTURE_CONFIG as CFG
from tracksync.sources.fixtures import page_lines



def _page(n, k, start=0):
    return {"offset": n, "_embedded": {"elements": [{"id": start + i, "subject": f"s{start + i}"} for i in range(k)]}}


def _write(dirpath, name, text):
    with open(os.path.join(dirpath, name), "w") as f:
        f.write(text)


def test_pages_stop_at_short_page(spark, tmp_path):
    d = str(tmp_path)
    _write(d, "page-1.json", json.dumps(_page(1, 3), indent=2))
    _write(d, "page-2.json", json.dumps(_page(2, 2, 3), indent=2))
    _write(d, "page-3.json", json.dumps(_page(3, 3, 5), indent=2))
    out = pages.read_pages(spark, d, page_size=3, multi_line=True)
    assert sorted(r.item["id"].toPython() for r in out.collect()) == [0, 1, 2, 3, 4]


def test_pages_stop_before_malformed_and_missing_key(spark, tmp_path):
    d = str(tmp_path)
    _write(d, "page-1.json", json.dumps(_page(1, 2)))
    _write(d, "page-2.json", "{ not json")
    _write(d, "page-3.json", json.dumps(_page(3, 2, 4)))
    out = pages.read_pages(spark, d, page_size=2, multi_line=True)
    assert sorted(r.item["id"].toPython() for r in out.collect()) == [0, 1]

    d2 = str(tmp_path / "b")
    os.makedirs(d2)
    _write(d2, "page-1.json", json.dumps(_page(1, 2)))
    _write(d2, "page-2.json", json.dumps({"offset": 2, "total": 0}))
    _write(d2, "page-3.json", json.dumps(_page(3, 2, 4)))
    out2 = pages.read_pages(spark, d2, page_size=2, multi_line=True)
    assert out2.count() == 2


def test_pages_roundtrip_from_spark_writer(spark, tmp_path):
    items = spark.range(0, 2500).select(F.col("id"), F.to_json(F.struct(F.col("id"))).alias("item_json"))
    path = str(tmp_path / "pages")
    page_lines(items, 1000).orderBy("place").select("value").write.text(path)
    out = pages.read_pages(spark, path, page_size=1000)
    got = out.groupBy("page").count().orderBy("page").collect()
    assert [(r.page, r["count"]) for r in got] == [(1, 1000), (2, 1000), (3, 500)]
    as_rows = pages.items_of_pages(page_lines(items, 1000), 1000)
    key = lambda df: sorted((r.page, r.pos) for r in df.collect())
    assert key(as_rows) == key(out)


def test_broken_line_takes_its_place_among_the_lines(spark, tmp_path):
    page = lambda n: json.dumps(_page(n, 2, 2 * n))
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir()
    b.mkdir()
    # a digit in the file's name is no page number where a file holds many pages
    _write(str(a), "part-00000-x.txt", "\n".join([page(1), page(2), '{"broken', page(4)]) + "\n")
    assert pages.read_pages(spark, str(a), page_size=2).count() == 4
    _write(str(b), "part-00001-x.txt", "\n".join([page(1), page(2)]) + "\n")
    _write(str(b), "part-00002-x.txt", "\n".join([page(3), page(4), "", '{"broken', page(6)]) + "\n")
    assert pages.read_pages(spark, str(b), page_size=2).count() == 8


def test_jdbc_options_validation():
    o = jdbc.jdbc_options("jdbc:x://h/db", table="t", partition_column="id", lower_bound=0, upper_bound=100,
                          num_partitions=4, custom_schema="id BIGINT")
    assert o["dbtable"] == "t" and o["numPartitions"] == "4" and o["customSchema"] == "id BIGINT"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x://h/db")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x://h/db", query="select 1", partition_column="id", lower_bound=0,
                          upper_bound=1, num_partitions=2)


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.range(3)
    first = publish.publish(spark, {"a": df, "b": df}, root)
    assert publish.current_run(spark, root) == first
    bad = df.select((F.col("id") / F.lit(0)).cast("int").alias("boom"))  # ANSI: fails at write time
    with pytest.raises(Exception):
        publish.publish(spark, {"a": df, "b": bad}, root)
    assert publish.current_run(spark, root) == first
    assert publish.read_current(spark, root, "a").count() == 3
    # the order of commits counts, not the ids callers choose
    publish.publish(spark, {"a": df}, root, "zz-first")
    publish.publish(spark, {"a": df.limit(1)}, root, "aa-second")
    assert publish.current_run(spark, root) == "aa-second" and publish.read_current(spark, root, "a").count() == 1


def test_spatial_grid_equals_brute_force(spark):
    rnd = random.Random(7)
    pts = [(i, float(rnd.randint(0, 60)), float(rnd.randint(0, 60))) for i in range(400)]
    # square, triangle and a concave polygon; integer vertices so on-edge points exist
    polys = {"sq": [(5, 5), (30, 5), (30, 30), (5, 30)], "tri": [(20, 20), (55, 20), (40, 55)],
             "sq2": [(10, 10), (40, 10), (40, 40), (10, 40)], "L": [(35, 2), (58, 2), (58, 30), (50, 30), (50, 10), (35, 10)]}
    edges = [(i, n[:2], k, float(a[0]), float(a[1]), float(b[0]), float(b[1]))
             for i, (n, vs) in enumerate(polys.items()) for k, (a, b) in enumerate(zip(vs, vs[1:] + vs[:1]))]
    P = spark.createDataFrame(pts, "gid_element long, x double, y double")
    E = spark.createDataFrame(edges, "area_id int, name string, seq int, x1 double, y1 double, x2 double, y2 double")
    got = sorted(tuple(r) for r in spatial.points_in_areas(P, E).collect())

    def inside(px, py, vs):
        n, c = len(vs), False
        for i in range(n):
            (x1, y1), (x2, y2) = vs[i], vs[(i + 1) % n]
            cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
            if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return True
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                c = not c
        return c

    # two areas of one name: a point in both is there twice
    want = sorted((i, n[:2]) for i, x, y in pts for n, vs in polys.items() if inside(x, y, vs))
    assert len(set(want)) < len(want)
    assert got == want and len(want) > 50


def test_large_polygon_is_tested_edge_by_strip(spark):
    """A ring of 20,000 edges, a comb of tall teeth and one of flat teeth: few edges for a point, equal to all edges."""
    import numpy as np

    rnd = np.random.default_rng(5)
    angle = np.linspace(0, 2 * np.pi, 20_000, endpoint=False)
    radius = 400 + 30 * np.sin(9 * angle) + rnd.uniform(-1, 1, len(angle))
    shapes = {1: [(float(a), float(b)) for a, b in zip(500 + radius * np.cos(angle), 500 + radius * np.sin(angle), strict=True)]}
    teeth = [(k, 900.0 * (k % 2)) for k in range(0, 601)]
    shapes[2] = [(float(x), y) for x, y in teeth] + [(600.0, -50.0), (0.0, -50.0)]
    shapes[3] = [(y, float(x)) for x, y in shapes[2]]
    rows = [(n, "area", k, *a, *b) for n, vs in shapes.items() for k, (a, b) in enumerate(zip(vs, vs[1:] + vs[:1], strict=True))]
    E = spark.createDataFrame(rows, "area_id int, name string, seq int, x1 double, y1 double, x2 double, y2 double")
    # whole-number points lie on teeth; one of them is there twice
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rnd.integers(-60, 1000, (500, 2)))]
    pts.append(pts[0])
    P = spark.createDataFrame(pts, "gid_element long, x double, y double")
    want = []
    for n, vs in shapes.items():
        a = np.array(vs)
        b = np.roll(a, -1, axis=0)
        for i, x, y in pts:
            cross = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
            near = (np.minimum(a, b) <= (x, y)).all(axis=1) & (np.maximum(a, b) >= (x, y)).all(axis=1)
            rise = b[:, 1] > a[:, 1]
            odd = (((a[:, 1] > y) != (b[:, 1] > y)) & ((cross > 0) == rise) & (cross != 0)).sum() % 2
            if odd or (near & (cross == 0)).any():
                want.append((i, "area"))
    assert sorted(tuple(r) for r in spatial.points_in_areas(P, E).collect()) == sorted(want) and len(want) > 300
    strips = spatial.edge_strips(E, spatial.polygons(E)).select("area_id", F.size("edges").alias("n"))
    held = {r.area_id: r for r in strips.groupBy("area_id").agg(F.sum("n").alias("rows"), F.avg("n").alias("mean"), F.max("n").alias("most")).collect()}
    assert all(held[n]["rows"] <= 4 * len(vs) for n, vs in shapes.items())
    # of 20,000 edges some tens; a tooth of the flat comb is one strip or two
    assert held[1]["mean"] < 40 and held[3]["most"] < 12


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_nested_loop_or_cartesian(spark):
    items = spark.createDataFrame([(1, 9, "R", 100), (2, 8, "2", 0)], "id long, type_id int, subject string, project_id int")
    values = spark.createDataFrame([(1, "WorkPackage", 1, 90, "2")],
                                   "id long, customized_type string, customized_id long, custom_field_id int, value string")
    rel = spark.createDataFrame([(5, 6, "relates")], "from_id long, to_id long, relation_type string")
    plan = _plan(links.link_items(items, values, rel, CFG))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    P = spark.createDataFrame([(1, 1.0, 1.0)], "gid_element long, x double, y double")
    E = spark.createDataFrame([(1, "a", 1, 0.0, 0.0, 2.0, 0.0), (1, "a", 2, 2.0, 0.0, 0.0, 2.0), (1, "a", 3, 0.0, 2.0, 0.0, 0.0)],
                              "area_id int, name string, seq int, x1 double, y1 double, x2 double, y2 double")
    plan = _plan(spatial.points_in_areas(P, E))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_unpivot_is_one_scan(spark, tmp_path):
    from tracksync.sources.fixtures import fixture
    from conftest import SMALL

    path = str(tmp_path / "reg")
    fixture(spark, SMALL, "fx_registry").write.parquet(path)
    plan = _plan(registry.scalar_attributes(spark.read.parquet(path), CFG))
    assert plan.count("FileScan parquet") == 1 and "Expand" in plan


def test_config_file_has_no_site_values(tmp_path):
    from dataclasses import asdict

    from tracksync.config import SyncConfig

    path = tmp_path / "c.json"
    given = asdict(CFG)
    del given["seed_exclude_prefix"]
    path.write_text(json.dumps(given))
    cfg = SyncConfig.from_file(str(path))
    assert cfg.seed_exclude_prefix is None and cfg.seed == CFG.seed and cfg.recode_map == CFG.recode_map and cfg.strict_json
    path.write_text(json.dumps({**given, "typo": 1}))
    with pytest.raises(ValueError):
        SyncConfig.from_file(str(path))
    del given["operator_id"]
    path.write_text(json.dumps(given))
    with pytest.raises(TypeError):
        SyncConfig.from_file(str(path))


def test_seeding_keeps_every_number_without_a_prefix(spark):
    from dataclasses import replace

    from tracksync.operators.items import seed_rows

    reg = spark.createDataFrame([("33001",), ("907",)], "num string")
    items = spark.createDataFrame([], "subject string")
    assert seed_rows(reg, items, replace(CFG, seed_exclude_prefix=None)).count() == 2
    assert seed_rows(reg, items, CFG).count() == 1


def test_csv_export_has_header_and_no_index(spark, tmp_path):
    from tracksync.operators import export

    df = spark.createDataFrame([("a", "1"), ("b", None)], "subject string, k string")
    path = str(tmp_path / "csv")
    export.write_table(df.coalesce(1), path, "csv")
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.endswith(".csv"))
    assert text.splitlines()[0] == "subject,k"
    assert sorted(text.splitlines()[1:]) == ["a,1", "b,"]


def test_filtered_export_reports_nothing_found(spark):
    from tracksync.operators import export

    items = spark.createDataFrame([('{"a":"x"}',)], "j string").select(
        export.parse_items(F.col("j")).alias("item"))
    assert export.require_rows(export.filter_and(items, {"a": ["x"]})).count() == 1
    with pytest.raises(export.NothingFound):
        export.require_rows(export.filter_and(items, {"a": ["nope"]}))


def test_prefix_predicate_reaches_the_scan(spark, tmp_path):
    from tracksync.functions import starts_with

    path = str(tmp_path / "reg")
    spark.createDataFrame([("907001",), ("332001",)], "num string").write.parquet(path)
    df = spark.read.parquet(path).filter(starts_with("num", "907"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(num,907)" in plan
    assert [r.num for r in df.collect()] == ["907001"]


def test_cli_sync_then_exports(spark, tmp_path):
    from conftest import SMALL

    from tracksync.__main__ import cmd_export_all, cmd_export_filtered, cmd_sync
    from tracksync.sources.fixtures import fixtures

    names = {"items": "fx_items", "values": "fx_values", "fields": "fx_fields", "projects": "fx_projects",
             "relations": "fx_relations", "state_days": "fx_state_days", "history": "fx_history",
             "registry": "fx_registry", "element": "fx_element", "conduct": "fx_conduct", "md": "fx_md",
             "points": "fx_points", "area_area": "fx_area_edges", "area_zone": "fx_zone_edges"}
    fx = fixtures(spark, SMALL, *names.values())
    tables = str(tmp_path / "tables")
    for t, n in names.items():
        fx[n].write.parquet(f"{tables}/{t}")
    out = str(tmp_path / "out")
    run_id = cmd_sync(spark, tables, out, None, CFG)
    assert publish.current_run(spark, out) == run_id
    assert publish.read_current(spark, out, "items").count() > fx["fx_items"].count()
    dest = str(tmp_path / "export")
    cmd_export_all(spark, out, dest, "parquet", CFG)
    assert spark.read.parquet(dest).count() == publish.read_current(spark, out, "items").count()

    # further runs go on from the published tables: nothing to seed, no row and no plan grows
    def state():
        tables = [publish.read_current(spark, out, n) for n in ("items", "values", "relations")]
        return [t.count() for t in tables], [len(t._jdf.queryExecution().analyzed().toString().splitlines()) for t in tables]

    first = state()
    for _ in range(2):
        assert cmd_sync(spark, tables, out, None, CFG) == publish.current_run(spark, out) != run_id
        assert state() == first

    pages_dir = str(tmp_path / "pages")
    os.makedirs(pages_dir)
    _write(pages_dir, "page-1.json", json.dumps(_page(1, 2)))
    dest2 = str(tmp_path / "filtered")
    cmd_export_filtered(spark, pages_dir, '{"subject": ["s1"]}', '{"1": "x"}', dest2, "parquet", 5)
    assert [r.subject for r in spark.read.parquet(dest2).collect()] == ["s1"]


@pytest.mark.parametrize("scale", [1e-6, 1.0, 20_000.0])
def test_grid_cells_are_few_in_any_unit(spark, scale):
    rnd = random.Random(11)
    P = spark.createDataFrame([(i, rnd.randint(0, 50) * scale, rnd.randint(0, 50) * scale) for i in range(300)],
                              "gid_element long, x double, y double")
    shapes = {1: [(3, 3), (40, 8), (25, 45)], 2: [(10, 10), (11, 10), (10, 11)], 3: [(5, 5), (5, 5), (5, 5)]}
    E = spark.createDataFrame([(n, "t", k, a[0] * scale, a[1] * scale, b[0] * scale, b[1] * scale)
                               for n, vs in shapes.items() for k, (a, b) in enumerate(zip(vs, vs[1:] + vs[:1]))],
                              "area_id int, name string, seq int, x1 double, y1 double, x2 double, y2 double")
    cells = spatial.polygon_cells(spatial.polygons(E)).groupBy("area_id").count().collect()
    assert len(cells) == 3 and max(r["count"] for r in cells) <= 4
    assert spatial.points_in_areas(P, E).count() > 20


def test_hot_owner_is_aggregated_before_the_join(spark):
    from tracksync.functions import ElementClasses

    n = 3000
    # owner 0 holds a third of all elements
    el = spark.createDataFrame([(g, 0 if g % 3 == 0 else g % 50, ["cr-1", "OTROS", "Poste", None][g % 4],
                                 ["x CR", None][g % 2], ["0", "1", None][g % 3]) for g in range(n)],
                               "gid long, owner_id long, kind string, note string, uso string")
    reg = spark.createDataFrame([(i, str(i % 20), 1, "m", "s") for i in range(50)],
                                "id long, num string, operator_id int, miga string, state string")
    got = {r.num: r.asDict() for r in registry.bucket_counts(reg, el, CFG).collect()}
    c = ElementClasses(CFG.vocab)
    naive = (reg.join(el, reg["id"] == el["owner_id"]).groupBy("num")
             .agg(F.count_if(c.cr_unused()).alias("n_chamber_idle"), F.count_if(c.rest()).alias("n_rest"),
                  F.count(F.lit(1)).alias("total")).collect())
    for r in naive:
        g = got[r.num]
        assert (g["n_chamber_idle"], g["n_rest"], g["total"]) == (r.n_chamber_idle, r.n_rest, r.total)
    plan = _plan(registry.bucket_counts(reg, el, CFG))
    agg_at = plan.find("HashAggregate(keys=[owner_id")
    assert agg_at != -1 and "partial_count" in plan
