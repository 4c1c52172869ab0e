"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are brought to one sphere (inner product becomes angle), projected to a few
coordinates by several random rotations, shifted, and each projection is ordered by its place
on a Hilbert curve.  Spark range-partitions every ordering into blocks at the quantiles of
its keys.  A query goes to its own block of each ordering and to the neighbouring ones of its
window; each block ranks its rows for its queries by the exact inner product, and the windows
of all orderings are merged.

Every row is in every ordering.  ``window`` is the share of an ordering that a query sees:
on vectors without structure a small window cannot hold 20 nearest rows, so it is a share and
not a count, and the work of n rows and q queries is q times ``curves * window`` times n.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, quoted, read_table, register

#: Rows of an ordering in one block.
BLOCK = 4096
_JITTER = 12


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows, dimensions), ``bits`` bits a coordinate.

    The transposed form of the place is worked out bit by bit from the top: inverted or
    exchanged low bits undo the rotation of each sub-cube, then a Gray decode; interleaving
    the bits of all coordinates gives the key.
    """
    x, one = [c.astype(np.uint64) for c in cells.T], np.uint64(1)
    n = len(x)
    for level in range(bits - 1, 0, -1):
        top, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(n):
            on = (x[i] & top) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = x[0] ^ np.where(on, low, swap if i else np.uint64(0))
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] & (one << np.uint64(level))) != 0, (one << np.uint64(level)) - one, np.uint64(0))
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << one | (x[i] ^ flip) >> np.uint64(level) & one
    return key


@dataclass
class Orderings:
    """Rotations and shifts of all curves, and the centre and spread of the projected rows."""

    rotations: np.ndarray  # (curves, dims + 1, kept)
    shifts: np.ndarray     # (curves, kept)
    largest: float         # largest norm of all rows
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None

    @classmethod
    def draw(cls, dims: int, curves: int, kept: int, largest: float, seed: int) -> Orderings:
        rng, kept = np.random.default_rng(seed), min(kept, dims + 1)
        turned = np.stack([np.linalg.qr(rng.standard_normal((dims + 1, kept)))[0] for _ in range(curves)])
        return cls(turned, rng.uniform(-0.1, 0.1, (curves, kept)), largest)

    def project(self, v: np.ndarray, query: bool) -> np.ndarray:
        """(curves, rows, kept).  Rows get the coordinate that completes their norm, queries are scaled alone."""
        if query:
            full = np.concatenate([v / np.linalg.norm(v, axis=1, keepdims=True), np.zeros((len(v), 1))], axis=1)
        else:
            scaled = v / self.largest
            full = np.concatenate([scaled, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1, keepdims=True)))], axis=1)
        return np.einsum("rd,cdk->crk", full, self.rotations, optimize=True)

    def keys(self, ids: np.ndarray, v: np.ndarray, query: bool) -> np.ndarray:
        """(curves, rows) places, lowest bits from the id, so that equal rows do not meet in one block."""
        kept = self.rotations.shape[2]
        bits = (62 - _JITTER) // kept
        z = (self.project(v, query) - self.centre[:, None]) / (6 * self.spread[:, None]) + 0.5 + self.shifts[:, None]
        cells = np.clip(z * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
        jitter = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _JITTER)
        return np.stack([(hilbert_keys(c, bits) << np.uint64(_JITTER) | jitter).astype(np.int64) for c in cells])


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, vec (binary, doubles) of the rows that take part.

    Left out: null ids and vectors; vectors that are zero, of another length than most, or hold
    a null or non-finite component.
    """
    v, finite = quoted(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = df.select(quoted(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = common[0]["n"] if common else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in flat], pa.binary())], names=["vec_id", "vec"])

    return rows.filter(F.size("v") == dims).mapInArrow(pack, "vec_id long, vec binary")


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def fit(vectors: DataFrame, curves: int, kept: int, seed: int) -> Orderings | None:
    """Draw the curves; largest norm, centre and spread are taken over all rows."""

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _vectors(batch.column(1))
                yield pa.RecordBatch.from_pydict({"largest": [float(np.sqrt((v**2).sum(axis=1)).max())], "dims": pa.array([v.shape[1]], pa.int32())})

    largest, dims = vectors.mapInArrow(norms, "largest double, dims int").agg(F.max("largest"), F.max("dims")).first()
    if largest is None:
        return None
    orders = Orderings.draw(dims, curves, kept, largest, seed)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                z = orders.project(_vectors(batch.column(1)), False)
                now = np.stack([np.full(z[:, 0].size, z.shape[1], float), z.sum(axis=1).ravel(), (z**2).sum(axis=1).ravel()])
                total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.shape[1]), pa.int32()), *(pa.array(t) for t in total)], names=["i", "n", "s", "ss"])

    rows = vectors.mapInArrow(sums, "i int, n double, s double, ss double").groupBy("i").agg(F.sum("n"), F.sum("s"), F.sum("ss")).orderBy("i").collect()
    n, s, ss = np.array([r[1:] for r in rows]).T
    shape = orders.shifts.shape
    orders.centre = (s / n).reshape(shape)
    orders.spread = np.sqrt(np.maximum(ss / n - (s / n) ** 2, 1e-12)).reshape(shape)
    return orders


def _rank_block(k: int):
    """Rows (role, vec_id, vec) of one block and the queries sent to it -> each query's k best rows here, exactly scored."""

    def run(table):
        role = table["role"].to_numpy()
        ids = table["vec_id"].to_numpy()
        vectors = _vectors(table["vec"].combine_chunks())
        rows, asked = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        out: list[tuple] = []
        if len(rows) and len(asked):
            held, names = vectors[rows], ids[rows]
            for at in range(0, len(asked), 64):
                some = asked[at:at + 64]
                q = vectors[some]
                near = q @ held.T
                near[ids[some][:, None] == names[None, :]] = -np.inf
                if near.shape[1] > k:
                    least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
                    slack = 1e-9 * np.abs(near, where=np.isfinite(near), out=np.zeros_like(near)).max(axis=1)
                    i, j = np.nonzero((near >= (least - slack)[:, None]) & np.isfinite(near))
                else:
                    i, j = np.nonzero(np.isfinite(near))
                # one way to add up for every pair, whatever its block: equal vectors tie exactly
                score = (q[i] * held[j]).sum(axis=1)
                order = np.lexsort((names[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                first = np.searchsorted(i, np.arange(len(some)))
                best = np.arange(len(i)) - first[i] < k
                out.append((ids[some][i[best]], names[j[best]], score[best]))
        a, b, s = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s, pa.float64())})

    return run


def nearest(df: DataFrame, queries, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", curves: int = 12, kept: int = 6, window: float = 0.15, seed: int = 11) -> DataFrame:
    """The ``k`` nearest found of each query row: query_id, rank, vec_id, score.

    ``queries`` is a condition on ``vec_id`` that names the query rows.  Nearness is the inner
    product in double precision; ties go to the smaller vec_id; a row is no candidate of its
    own id; rows repeated under one id count once.  An empty table, or no usable row, finds
    nothing.  Other columns are not read.
    """
    vectors = materialise(usable(df, id_col, vec_col), "ann-vectors")
    orders = fit(vectors, curves, kept, seed)
    if orders is None:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).filter(F.lit(False))

    def keyed(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    keys = orders.keys(batch.column(0).to_numpy(), _vectors(batch.column(1)), query)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(list(keys.T), pa.list_(pa.int64()))], names=["vec_id", "vec", "keys"])
        return run

    placed = materialise(vectors.mapInArrow(keyed(False), "vec_id long, vec binary, keys array<long>"), "ann-keys")
    asked = vectors.filter(queries).mapInArrow(keyed(True), "vec_id long, vec binary, keys array<long>")
    blocks = -(-placed.count() // BLOCK)
    points = [i / blocks for i in range(1, blocks)]
    if points:
        found = placed.select(F.posexplode("keys").alias("curve", "key")).groupBy("curve").agg(F.percentile_approx("key", points, max(10_000, 10 * blocks)).alias("b")).collect()
        bounds = {r["curve"]: np.array(r["b"]) for r in found}
    else:
        bounds = {c: np.zeros(0, np.int64) for c in range(curves)}
    reach = int(np.ceil(window / 2 * blocks)) if blocks > 1 else 0

    def dealt(role: int, far: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    rows = part.num_rows
                    keys = part.column(2).flatten().to_numpy().reshape(rows, -1)
                    for c in range(keys.shape[1]):
                        own = np.searchsorted(bounds[c], keys[:, c], side="right")
                        for step in range(-far, far + 1):
                            there = np.flatnonzero((own + step >= 0) & (own + step < blocks))
                            if len(there):
                                some = part.take(pa.array(there))
                                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(there), c), pa.int32()), pa.array(own[there] + step, pa.int32()),
                                                                  pa.array(np.full(len(there), role), pa.int32()), some.column(0), some.column(1)], names=["curve", "block", "role", "vec_id", "vec"])
        return run

    schema = "curve int, block int, role int, vec_id long, vec binary"
    both = placed.mapInArrow(dealt(0, 0), schema).unionByName(asked.mapInArrow(dealt(1, reach), schema))
    met = both.groupBy("curve", "block").applyInArrow(_rank_block(k), "query_id long, vec_id long, score double")
    merged = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@register("op2_hilbert_ann")
def op2_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
