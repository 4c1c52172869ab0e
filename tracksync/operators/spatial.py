"""Boundary-inclusive point-in-polygon join without a cross join.

Spark 4.1 has no ``ST_Intersects``.  Polygons arrive as edge lists
(area_id, name, seq, x1, y1, x2, y2); points as (gid_element, x, y).  The identity of an
area is its id: two areas may share a name.

Plan: (1) each polygon belongs to the grid level whose cell, a power of two, is the
smallest that is at least as long as its bounding box, so it covers at most four cells
whatever its size or unit; (2) each point has one cell on every level in use; (3) an
equi-join on (level, cell) with the bounding box in the cell row gives candidates; (4) the
edges of a polygon lie in horizontal strips, and an equi-join on (area, strip) brings a
candidate only the edges that its own height can meet; (5) an exact test on those edges
keeps a pair when the point lies on one or the ray crossing count is odd.  An edge that
reaches no height of the strip neither holds nor is crossed from any of its points, so the
strip's edges decide like all edges.  Products replace divisions, so integer coordinates
are tested exactly.

A strip is as high as a polygon's edges are on average, rounded up to a power of two: all
strips together hold at most about three rows an edge, and the points of one large area
spread over its strips.  A point is tested against about as many edges as a horizontal line
through the polygon meets: few for an outline, all teeth of a comb that stands upright.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Length a polygon of no extent (a point, a repeated vertex) is given a cell for.
LEAST_LENGTH = 2.0 ** -40


def _level(length: Column) -> Column:
    """Exponent of the smallest power of two that is at least ``length``."""
    return F.ceil(F.log2(F.greatest(length, F.lit(LEAST_LENGTH)))).cast("int")


def polygons(edges: DataFrame) -> DataFrame:
    """(area_id, name, bounding box, strip_level) per polygon, from partial aggregates only."""
    return edges.groupBy("area_id").agg(
        F.min("name").alias("name"),
        F.min(F.least("x1", "x2")).alias("minx"), F.max(F.greatest("x1", "x2")).alias("maxx"),
        F.min(F.least("y1", "y2")).alias("miny"), F.max(F.greatest("y1", "y2")).alias("maxy"),
        _level(F.avg(F.abs(F.col("y2") - F.col("y1")))).alias("strip_level"))


def edge_strips(edges: DataFrame, polys: DataFrame) -> DataFrame:
    """(area_id, strip, edges): for each horizontal strip of an area the edges that reach into it."""
    e = edges.select("area_id", F.struct("x1", "y1", "x2", "y2").alias("edge"))
    e = e.join(polys.select("area_id", "strip_level"), "area_id")
    low, high = F.least("edge.y1", "edge.y2"), F.greatest("edge.y1", "edge.y2")
    e = e.withColumn("strip", F.explode(F.sequence(_cell(low, "strip_level"), _cell(high, "strip_level"))))
    return e.groupBy("area_id", "strip").agg(F.collect_list("edge").alias("edges"))


def _cell(value: Column | str, level: Column | str) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.floor(v / F.pow(F.lit(2.0), F.col(level) if isinstance(level, str) else level))


def polygon_cells(polys: DataFrame) -> DataFrame:
    """(area_id, name, strip_level, level, cx, cy, bbox) for the at most four cells a polygon's bounding box meets."""
    length = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    leveled = polys.select("area_id", "name", "strip_level", "minx", "maxx", "miny", "maxy", _level(length).alias("level"))
    wide = leveled.withColumn("cx", F.explode(F.sequence(_cell("minx", "level"), _cell("maxx", "level"))))
    return wide.withColumn("cy", F.explode(F.sequence(_cell("miny", "level"), _cell("maxy", "level"))))


def on_edge(x: Column, y: Column):
    def f(e):
        cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        return ((cross == 0)
                & (x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
                & (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"])))
    return f


def crosses(x: Column, y: Column):
    """Ray to +x crosses the edge: straddles y and the crossing lies right of x (no division)."""
    def f(e):
        straddle = (e["y1"] > y) != (e["y2"] > y)
        d = e["y2"] - e["y1"]
        lhs = (x - e["x1"]) * d
        rhs = (e["x2"] - e["x1"]) * (y - e["y1"])
        return straddle & F.when(d > 0, lhs < rhs).otherwise(lhs > rhs)
    return f


def contains(edges: Column, x: Column, y: Column) -> Column:
    return F.exists(edges, on_edge(x, y)) | (F.size(F.filter(edges, crosses(x, y))) % 2 == 1)


def points_in_areas(points: DataFrame, edges: DataFrame) -> DataFrame:
    """(gid_element, name) for every point inside or on the boundary of an area (bag over areas)."""
    polys = polygons(edges)
    cells = polygon_cells(polys)
    # the levels in use: at most the binary exponents of a double, in practice a handful
    levels = sorted(r[0] for r in cells.select("level").distinct().collect())
    pts = points.select("gid_element", "x", "y", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")).alias("level"))
    pts = pts.withColumn("cx", _cell("x", "level")).withColumn("cy", _cell("y", "level"))
    x, y = F.col("x"), F.col("y")
    in_box = (x >= F.col("minx")) & (x <= F.col("maxx")) & (y >= F.col("miny")) & (y <= F.col("maxy"))
    cand = pts.join(cells, ["level", "cx", "cy"]).filter(in_box).select(
        "gid_element", "x", "y", "area_id", "name", _cell("y", "strip_level").alias("strip"))
    j = cand.join(edge_strips(edges, polys), ["area_id", "strip"])
    return j.filter(contains(F.col("edges"), x, y)).select("gid_element", "name")
