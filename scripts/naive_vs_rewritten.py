"""
anti join, spatial join.  One warm-up, then the median of three, noop sink.

usage: BENCH_CPUS=4 python scripts/naive_vs_rewritten.py [sf_dir]
The naive forms are measurement baselines only; the library never runs them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

sys.path.insert(1, str(Path(__file__).resolve().parents[1] / "tests"))

import naive  # noqa: E402
from tracksync.operators import links, registry, spatial  # noqa: E402
from tracksync.session import local_session  # noqa: E402
from tracksync.sources.fixtures import FIXTURE_CONFIG as CFG, fixtures  # noqa: E402



def timed(df, reps=3):
    runs = []
    for i in range(reps + 1):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        if i:
            runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    fx = fixtures(spark, sf, "fx_registry", "fx_element", "fx_conduct", "fx_items", "fx_values", "fx_relations",
                  "fx_points", "fx_area_edges")
    out = {}

    # fan-out counts: registry x element x conduct
    out["fanout_rewritten"] = timed(registry.capacity(fx["fx_registry"], fx["fx_element"], fx["fx_conduct"], CFG))
    out["fanout_naive"] = timed(naive.capacity_naive(fx["fx_registry"], fx["fx_element"], fx["fx_conduct"], CFG))

    # symmetric-pair anti join
    cand = links.link_candidates(fx["fx_items"], fx["fx_values"], CFG)
    out["anti_join_rewritten"] = timed(links.symmetric_anti_join(cand, fx["fx_relations"]))
    p, e = cand.alias("p"), fx["fx_relations"].alias("e")
    cond = (((F.col("e.from_id") == F.col("p.from_id")) & (F.col("e.to_id") == F.col("p.to_id")))
            | ((F.col("e.from_id") == F.col("p.to_id")) & (F.col("e.to_id") == F.col("p.from_id"))))
    out["anti_join_naive_or"] = timed(p.join(e, cond, "left_anti"))

    # spatial: grid equi-join vs a bounding-box theta join (nested loop)
    out["spatial_grid"] = timed(spatial.points_in_areas(fx["fx_points"], fx["fx_area_edges"]))
    rings = fx["fx_area_edges"].groupBy("area_id").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    polys = spatial.polygons(fx["fx_area_edges"]).join(rings, "area_id")
    pts = fx["fx_points"]
    bbox = ((pts["x"] >= polys["minx"]) & (pts["x"] <= polys["maxx"])
            & (pts["y"] >= polys["miny"]) & (pts["y"] <= polys["maxy"]))
    theta = pts.join(polys, bbox).filter(spatial.contains(F.col("edges"), F.col("x"), F.col("y"))).select(
        "gid_element", "name")
    out["spatial_naive_theta"] = timed(theta)
    print(json.dumps({"sf_dir": sf, "cpus": int(cpus), "seconds": out}))


if __name__ == "__main__":
    main()
