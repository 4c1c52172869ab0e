"""Near duplicates of vectors through an index of pivot permutations.

1. Equal vectors are one class; everything after runs over classes.
2. Reference points (pivots) are chosen far apart from a bounded sample, so that a dense group of
   near copies holds few of them and its members order them alike.  A class is described by its
   ``prefix`` nearest pivots, in the order of nearness.
3. Each pivot has an inverted list of the classes that name it.  Two classes are candidates if their
   prefixes share ``shared`` pivots or more.  Of a prefix's pivots, taken from the shortest list to
   the longest, all but the last ``shared - 1`` are posted: candidates still meet in the list of the
   first pivot they share, and there alone they are counted and verified.
4. Lists are cut into blocks of about ``BLOCK`` classes, and a task takes a pair of blocks: shared
   pivots are counted, then candidates verified by their exact cosine.  A pair of blocks gives
   link counts and a star for each linked group, so a list of any length, a group of near copies
   above all, makes no row for a pair and is never held by one task.
5. Components of the stars give each vector its group.

n vectors and m pivots cost n*m to describe and about (prefix * n)^2 / 2m to look up; m is
``prefix * sqrt(n / 2)``, where both are equal, up to ``MAX_PIVOTS``.  Beyond that number (about
a million vectors) lists grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, quoted, read_table, register, with_row_id
from .components import components

MIN_PIVOTS = 16
MAX_PIVOTS = 4096
#: Pivots are chosen from this many sampled classes for each pivot wanted: at most SAMPLE * MAX_PIVOTS vectors on the driver.
SAMPLE = 4
#: No pivot has a larger cosine than this with another.
APART = 0.8
BLOCK = 1024
#: A class with at least one in this many of all rows is hot; there are at most as many.
HOT_SHARE = 1000


def packed(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(_row, vec_id, vec) of every row, vec its components' bytes; and their numpy type.

    ``vec`` is null for vectors that can link with nothing: null or zero ones, those that hold a null
    or non-finite component, and those of another length than most usable ones (of equally
    frequent lengths: the smallest).
    """
    inner = df.select(quoted(vec_col)).schema[0].dataType.elementType.simpleString()
    kind, code = ("float", "<f4") if inner == "float" else ("double", "<f8")
    v, finite = F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = df.select(quoted(id_col).alias("vec_id"), quoted(vec_col).cast(f"array<{kind}>").alias("v"))
    fine = F.coalesce(F.forall("v", finite) & F.exists("v", lambda x: x != 0), F.lit(False))
    common = rows.filter(fine).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = common[0]["n"] if common else 0
    rows = rows.select("vec_id", F.when(fine & (F.size("v") == dims), v).alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = column.drop_null().flatten().to_numpy(zero_copy_only=False).astype(code).reshape(-1, max(dims, 1))
            held, out = iter(flat), []
            for known in column.is_valid().to_pylist():
                out.append(next(held).tobytes() if known else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vec"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return with_row_id(rows.mapInArrow(pack, f"vec_id {id_type}, vec binary"), "_row"), code


def unit_vectors(column: list[bytes], code: str) -> np.ndarray:
    """Rows of length 1, in double precision."""
    v = np.frombuffer(b"".join(column), code).astype(np.float64).reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def far_apart(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` rows of ``sample``, each the one least like those taken before."""
    if not len(sample):
        return sample
    taken, nearest = [0], sample @ sample[0]
    while len(taken) < wanted:
        least = int(nearest.argmin())
        if nearest[least] > APART:
            break
        taken.append(least)
        nearest = np.maximum(nearest, sample @ sample[least])
    return sample[taken]


def choose_pivots(classes: DataFrame, code: str, count: int, prefix: int) -> np.ndarray:
    """Pivots from a sample of the classes, drawn by a hash of the vector."""
    wanted = int(min(MAX_PIVOTS, max(MIN_PIVOTS, prefix * np.sqrt(count / 2))))
    draw = F.pmod(F.xxhash64("vec", F.lit(29)), F.lit(1 << 30))
    share = min(1.0, 2 * SAMPLE * wanted / max(count, 1))
    sample = classes.filter(draw < int(share * (1 << 30)) + 1).orderBy(draw, "vec").select("vec").limit(SAMPLE * wanted).collect()
    return far_apart(unit_vectors([bytes(r["vec"]) for r in sample], code) if sample else np.zeros((0, 1)), wanted)


def nearest_pivots(pivots: np.ndarray, code: str, prefix: int):
    """A mapInArrow function: class, weight, vec -> the same and the numbers of the nearest pivots, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                like = unit_vectors(part.column(2).to_pylist(), code) @ pivots.T
                order = np.argsort(-like, axis=1, kind="stable")[:, :prefix].astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(order), pa.list_(pa.int32()))], names=["class", "weight", "vec", "pivots"])

    return run


def _verify_blocks(code: str, at_least: float, shared: int):
    """One pair (i, j) of blocks of the list at place ``place``: rows (class, weight, vec, places, block) -> links and stars.

    ``places`` are the places of a row's pivots in the order of list lengths, ascending.
    """

    def run(key, table):
        place, i, j = (k.as_py() for k in key)
        names, weight = table["class"].to_numpy(), table["weight"].to_numpy()
        block = table["block"].to_numpy()
        places = table["places"].combine_chunks().flatten().to_numpy().reshape(len(names), -1)
        unit = unit_vectors(table["vec"].to_pylist(), code)
        left, right = (np.arange(len(names)),) * 2 if i == j else (np.flatnonzero(block == i), np.flatnonzero(block == j))
        common, earlier = np.zeros((len(left), len(right)), np.int8), np.zeros((len(left), len(right)), bool)
        for a in range(places.shape[1]):
            for b in range(places.shape[1]):
                same = places[left, a][:, None] == places[right, b][None, :]
                common += same
                earlier |= same & (places[left, a] < place)[:, None]
        candidates = (common >= shared) & ~earlier
        if i == j:
            np.fill_diagonal(candidates, False)
        linked = candidates & (unit[left] @ unit[right].T >= at_least)
        # link counts by weight, and each row's group within this pair of blocks: the least name it reaches
        links = np.zeros(len(names), np.int64)
        links[left] += linked @ weight[right]
        if i != j:
            links[right] += weight[left] @ linked
        group, before = names.copy(), None
        while before is None or (group != before).any():
            before = group.copy()
            top = np.iinfo(np.int64).max
            group[left] = np.minimum(group[left], np.where(linked, group[right][None, :], top).min(axis=1, initial=top))
            group[right] = np.minimum(group[right], np.where(linked, group[left][:, None], top).min(axis=0, initial=top))
        some = np.flatnonzero(links > 0)
        return pa.table({"a": pa.array(names[some], pa.int64()), "b": pa.array(group[some], pa.int64()), "links": pa.array(links[some], pa.int64())})

    return run


def linked_classes(classes: DataFrame, code: str, count: int, at_least: float, prefix: int, shared: int) -> DataFrame:
    """classes (class, weight, vec), materialised -> (a, b, links): stars of linked groups, with shares of a's link count."""
    pivots = choose_pivots(classes, code, count, prefix)
    schema = "class long, weight long, vec binary, pivots array<int>"
    described = materialise(classes.select("class", "weight", "vec").mapInArrow(nearest_pivots(pivots, code, prefix), schema), "pivot-described")
    kept = min(prefix, len(pivots))
    needed = min(shared, kept)
    # one row for each pivot: its place when lists are ordered by length
    lengths = described.select(F.explode("pivots").alias("pivot")).groupBy("pivot").count().collect()
    place_of = np.zeros(len(pivots), np.int32)
    for place, row in enumerate(sorted(lengths, key=lambda r: (r["count"], r["pivot"]))):
        place_of[row["pivot"]] = place
    blocks = {int(place_of[r["pivot"]]): -(-r["count"] // BLOCK) for r in lengths}

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                places = np.sort(place_of[part.column(3).flatten().to_numpy().reshape(part.num_rows, kept)], axis=1)
                row, which = (x.ravel() for x in np.indices((part.num_rows, kept - needed + 1)))
                place = places[row, which]
                many = np.array([blocks[p] for p in place.tolist()])
                own = (part.column(0).to_numpy()[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % many
                entry = np.repeat(np.arange(len(row)), many)  # each meets every block of its list, its own too
                other = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many)
                held = part.take(pa.array(row[entry]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[entry], pa.int32()), pa.array(np.minimum(own[entry], other), pa.int32()), pa.array(np.maximum(own[entry], other), pa.int32()),
                     pa.array(own[entry], pa.int32()), held.column(0), held.column(1), held.column(2), pa.array(list(places[row[entry]]), pa.list_(pa.int32()))],
                    names=["place", "i", "j", "block", "class", "weight", "vec", "places"])

    posted = described.mapInArrow(post, "place int, i int, j int, block int, class long, weight long, vec binary, places array<int>")
    return posted.groupBy("place", "i", "j").applyInArrow(_verify_blocks(code, at_least, needed), "a long, b long, links long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", at_least: float = 0.95, prefix: int = 6, shared: int = 2) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept.

    Rows link whose cosine, in double precision, is found to be ``at_least`` or more.  ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest id reachable by links,
    ``kept`` says that it is the row's own.  Equal vectors and repeated rows link.  Vectors that are
    null, zero or of another length than most, or hold null or non-finite components, link with
    nothing and are their own component.  A null id is compared like any other but names a
    component only if no other id does; rows of equal ids are rows of their own.  An empty table
    gives no rows.  Other columns are not read.
    """
    rows, code = packed(df, id_col, vec_col)
    rows = materialise(rows, "pivot-rows")
    known = rows.filter("vec IS NOT NULL")
    grouped = known.groupBy("vec").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least_id"))
    classes = materialise(with_row_id(grouped, "class"), "pivot-classes")
    count, total = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    found = materialise(linked_classes(classes, code, count, at_least, prefix, shared), "pivot-links") if count else \
        classes.select(F.col("class").alias("a"), F.col("class").alias("b"), F.lit(0).cast("long").alias("links"))
    roots = components(found.select("a", "b"))
    members = classes.select("class", "least_id").join(roots, F.col("class") == F.col("node"))
    named = members.select("class", "root").join(members.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
    links = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    result = classes.join(named.select("class", "component_id"), "class", "left").join(links, "class", "left") \
        .select("vec", "weight", F.coalesce("component_id", "least_id").alias("component_id"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    result = materialise(result, "pivot-result")
    # rows of hot vectors meet their class in place: at most HOT_SHARE classes are sent to all tasks
    hot = result.filter(F.col("weight") * HOT_SHARE >= max(total, HOT_SHARE * HOT_SHARE))
    own = known.select("vec_id", "vec")
    few = own.join(F.broadcast(hot), "vec")
    rest = own.join(F.broadcast(hot.select("vec")), "vec", "left_anti").join(result, "vec")
    out = few.unionByName(rest).select("vec_id", "n_links", "component_id") \
        .unionByName(rows.filter("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@register("op12_pivot_neardup")
def op12_pivot_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
