"""N-gram Jaccard join by prefixes under several global token orders.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` of their distinct word-shingle
sets.  Under any one order of all tokens, the first ``n - ceil(percent/100 * n) + 1`` tokens
of two linked sets of n tokens share one; so a candidate pair must share a prefix token under
every one of several orders, and the pairs of all orders are intersected before any is
verified.  The orders all put rare tokens first, so that a prefix says much:

1. Equal sets are one class (128-bit fingerprint); the join runs over classes.
2. First order: a quarter of the token space (by hash), the tokens of one class only before
   the others.  A class whose prefix holds only such tokens can link with nothing and goes.
   This needs one aggregation by token and no join.
3. The sets of the classes that stay are taken whole, and the same test runs over all their
   tokens, twice, as tokens become unique when classes go.
4. Second to fourth order: document frequency among the classes that stay, with three ways to
   rank equals.  Prefixes under the second give the buckets; sizes, positions and the prefixes
   under the other two filter the pairs.
5. Pairs of small buckets are verified one by one.  A bucket of more than ``BUCKET`` classes
   is cut into blocks of about ``BLOCK``, and pairs of blocks are verified by matrix products,
   so no task holds a whole bucket and no row is made for a pair that does not link; the prefixes
   of the other orders filter there as well; each block
   pair returns link counts and a star for each linked group.
6. Components of the links give each document its class of the join.

Tokens are 64-bit hashes of shingles: two given sets have a chance of about
``|A| * |B| / 2**64`` to be taken for more similar than they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_by_worker, materialise, quoted, read_table, register, small_batches, with_row_id
from .components import components

#: One token in this many is in the space of the first order.
SPACE = 4
BUCKET = 64
BLOCK = 512
#: A class with at least one in this many of all documents is hot; there are at most as many.
HOT_SHARE = 1000
#: Keys (a long each) a broadcast may hold; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_SALTS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
_PIECE = 1 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    size = max(_PIECE + (1 << 12), 1 << n.bit_length())
    make = lambda: [np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)], dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    up, down = held_by_worker("powers", size, make)
    return up, down


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(begin, hash) of every word, A-Z lower-cased: differences of one running polynomial sum."""
    begins, hashes, at = [], [], 0
    raw = np.frombuffer(data, np.uint8)
    while at < len(data):
        end = min(len(data), at + _PIECE)
        while end < len(data) and not _SPACES[raw[end]]:  # a word is never cut
            end += 1
        part = _LOWER[raw[at:end]]
        space = np.concatenate([[True], _SPACES[part], [True]])
        edge = np.flatnonzero(space[1:] != space[:-1])
        b, e = edge[::2], edge[1::2]
        up, down = _powers(len(part) + 1)
        total = np.r_[np.uint64(0), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], dtype=np.uint64)]
        hashes.append(_mix((total[e] - total[b]) * down[b]))
        begins.append(b + at)
        at = end
    return (np.concatenate(begins), np.concatenate(hashes)) if begins else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, of none the empty set."""
    parts = [(t or "").encode() for t in texts]
    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    begins, hashes = word_hashes(b" ".join(parts))
    cut = np.searchsorted(begins, starts)
    salts = _mix(np.arange(1, words + 1, dtype=np.uint64) * _SALTS[0]) | np.uint64(1)
    joined = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        joined += hashes[k:k + len(joined)] * salts[k]
    joined = _mix(joined)
    out = []
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if hi - lo >= words:
            out.append(np.unique(joined[lo:hi - words + 1]))
        elif hi > lo:
            out.append(_mix((hashes[lo:hi] * salts[:hi - lo]).sum(keepdims=True, dtype=np.uint64) + _SALTS[hi - lo & 3]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _measured(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n, h1, h2 (set fingerprint; null for the empty set), tokens in the first order's space."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = shingle_sets(part.column(2).to_pylist(), words)
                prints = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                     pa.array([s[s % np.uint64(SPACE) == 0].view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "text_hash", "n", "h1", "h2", "tokens"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, f"doc_id {kind}, text_hash long, n long, h1 long, h2 long, tokens array<long>")


def _whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """docs (cid, n, weight, text) -> cid, n, weight, tokens of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = shingle_sets(part.column(3).to_pylist(), words)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["cid", "n", "weight", "tokens"])

    return docs.mapInArrow(run, "cid long, n long, weight long, tokens array<long>")


def _unique_tokens(sets: DataFrame, *keys: str) -> DataFrame:
    """(keys, r): how many of the tokens of a class, named by ``keys``, no other class has."""
    tokens = sets.select(*keys, F.explode("tokens").alias("token"))
    ends = [f(k).alias(f"{k}_{n}") for k in keys for n, f in (("least", F.min), ("most", F.max))]
    owner = tokens.groupBy("token").agg(*ends).filter(" AND ".join(f"{k}_least = {k}_most" for k in keys))
    return owner.groupBy(*[F.col(f"{k}_least").alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("r"))


def _small(keys: DataFrame) -> DataFrame:
    """``keys`` with a broadcast hint if it holds at most BROADCAST_KEYS rows; else Spark shuffles."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys


def _linked(common, n, m, percent: int):
    return 100 * common >= percent * (n + m - common)


def _block_links(percent: int):
    """Verify one pair of blocks of one bucket: rows (cid, n, weight, kept, p3, p4, bigs, block), the key (token, i, j).

    Rows of a bucket share a token of the second order's prefixes; pairs must share one of the third's and fourth's, too.
    """

    def run(key, table):
        token, i, j = (k.as_py() for k in key)
        block, cid = table["block"].to_numpy(), table["cid"].to_numpy()
        order = np.lexsort((cid, block))
        table, block, cid = table.take(pa.array(order)), block[order], cid[order]
        n, weight = table["n"].to_numpy(), table["weight"].to_numpy()
        rows = len(cid)
        pairs = _common(table["p3"], rows) > 0
        pairs &= _common(table["p4"], rows) > 0
        common = _common(table["kept"], rows) if pairs.any() else np.zeros((rows, rows), np.int64)
        pairs &= _linked(common, n[:, None], n[None, :], percent) & (block[:, None] != block[None, :] if i != j else np.ones((rows, rows), bool))
        # a pair is counted in the first of the large buckets it shares: by token
        lists = table["bigs"].combine_chunks()
        before = [[t for t in b.as_py() if t < token] for b in lists]
        if any(before):
            pairs &= _common(pa.chunked_array([pa.array(before, pa.list_(pa.int64()))]), rows) == 0
        np.fill_diagonal(pairs, False)
        root = np.full(rows, -1)
        for s in range(rows):
            if root[s] < 0:
                root[s], front = s, np.array([s])
                while len(front):
                    front = np.flatnonzero(pairs[front].any(axis=0) & (root < 0))
                    root[front] = s
        touched = np.flatnonzero(pairs.any(axis=0))
        return pa.table({"a": pa.array(cid[touched], pa.int64()), "b": pa.array(cid[root[touched]], pa.int64()), "links": pa.array((pairs[touched] * weight[None, :]).sum(axis=1), pa.int64())})

    return run


def _common(lists: pa.ChunkedArray, rows: int, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all rows' token lists, by products of 0/1 matrices over some tokens at a time."""
    flat = lists.combine_chunks()
    owner = np.repeat(np.arange(rows), np.diff(flat.offsets.to_numpy()))
    tokens = flat.values.to_numpy()[flat.offsets[0].as_py():flat.offsets[-1].as_py()]
    _, place, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[place] > 1
    owner, (names, place) = owner[shared], np.unique(place[shared], return_inverse=True)
    out = np.zeros((rows, rows), np.float32)
    by = np.argsort(place, kind="stable")
    owner, place = owner[by], place[by]
    for at in range(0, len(names), width):
        lo, hi = np.searchsorted(place, [at, at + width])
        held = np.zeros((rows, min(width, len(names) - at)), np.float32)
        held[owner[lo:hi], place[lo:hi] - at] = 1
        out += held @ held.T
    return out.astype(np.int64)


def similar_classes(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``sets`` (cid, n, weight, tokens), materialised -> edges (a, b) spanning every linked group, and (cid, links)."""
    least = lambda n: F.expr(f"(({percent}) * {n} + 99) div 100")
    for _ in range(2):  # step 3
        alive = sets.join(_unique_tokens(sets, "cid"), "cid", "left").filter(F.col("n") - F.coalesce("r", F.lit(0)) >= least("n")).select("cid")
        sets = materialise(sets.join(_small(materialise(alive, "jaccard-alive")), "cid", "left_semi"), "jaccard-sets")
    # step 4: tokens of two classes or more, with their frequency
    tokens = sets.select("cid", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    kept = tokens.join(counts, "token").groupBy("cid").agg(F.collect_list(F.struct("df", "token")).alias("kept"))
    lists = sets.select("cid", "n", "weight").join(kept, "cid").withColumn("k", F.size("kept").cast("long")) \
        .withColumn("p", F.greatest(F.col("k") - least("n") + 1, F.lit(0)).cast("int"))

    def prefix(rank):
        ranked = F.array_sort(F.transform("kept", lambda x: F.struct(*[r.alias(f"_{i}") for i, r in enumerate(rank(x))], x["token"].alias("token"))))
        return F.transform(F.slice(ranked, F.lit(1), F.col("p")), lambda x: x["token"])

    lists = lists.filter("p > 0").select(
        "cid", "n", "weight", "k", F.array_sort(F.transform("kept", lambda x: x["token"])).alias("kept"),
        prefix(lambda x: [x["df"], x["token"]]).alias("p2"), prefix(lambda x: [x["df"], F.xxhash64(x["token"])]).alias("p3"),
        prefix(lambda x: [F.floor(F.log2(x["df"].cast("double"))), F.xxhash64(x["token"], F.lit(4))]).alias("p4"))
    lists = materialise(lists, "jaccard-lists")
    index = lists.select("cid", "n", "k", F.posexplode("p2").alias("pos", "token"))
    sizes = materialise(index.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "jaccard-buckets")
    large = sizes.filter(F.col("m") > BUCKET)
    # large buckets of each class
    bigs = materialise(index.select("cid", "token").join(large, "token"), "jaccard-large")
    big_lists = bigs.groupBy("cid").agg(F.sort_array(F.collect_list("token")).alias("bigs"))
    # small buckets: the pairs themselves, at most BUCKET / 2 for each row of the index
    near = index.join(sizes.filter(F.col("m") <= BUCKET).select("token"), "token")
    a, b = near.alias("a"), near.alias("b")
    need = F.expr(f"({percent} * (a.n + b.n) + {99 + percent}) div {100 + percent}")
    room = F.least(F.col("a.k") - F.col("a.pos"), F.col("b.k") - F.col("b.pos")) + F.least("a.pos", "b.pos")
    fits = (F.col("a.token") == F.col("b.token")) & (F.col("a.cid") < F.col("b.cid")) \
        & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")) & (F.least("a.k", "b.k") >= need) & (room >= need)
    pairs = a.join(b, fits).select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).distinct()
    full = lists.join(big_lists, "cid", "left").withColumn("bigs", F.coalesce("bigs", F.array().cast("array<long>")))
    full = materialise(full.select("cid", "n", "weight", "kept", "p3", "p4", "bigs"), "jaccard-full")
    tests = lambda s: full.select(F.col("cid").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "weight", "p3", "p4", "bigs")])
    pairs = pairs.join(tests("a"), "a").join(tests("b"), "b").filter(
        F.arrays_overlap("a_p3", "b_p3") & F.arrays_overlap("a_p4", "b_p4") & ~F.arrays_overlap("a_bigs", "b_bigs")).select("a", "b", "a_n", "b_n", "a_weight", "b_weight")
    of = lambda s: full.select(F.col("cid").alias(s), F.col("kept").alias(f"{s}_kept"))
    verified = pairs.join(of("a"), "a").join(of("b"), "b").withColumn("common", F.size(F.array_intersect("a_kept", "b_kept"))) \
        .filter(_linked(F.col("common"), F.col("a_n"), F.col("b_n"), percent)).select("a", "b", "a_weight", "b_weight")
    verified = materialise(verified, "jaccard-links")
    # step 5, large buckets: every class once for each other block of its bucket
    blocks = bigs.withColumn("blocks", F.floor((F.col("m") + BLOCK - 1) / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("cid", "token", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    stars = blocks.join(full.select("cid", "n", "weight", "kept", "p3", "p4", "bigs"), "cid").groupBy("token", "i", "j").applyInArrow(_block_links(percent), "a long, b long, links long")
    stars = materialise(stars, "jaccard-stars")
    edges = verified.select("a", "b").unionByName(stars.select("a", "b"))
    links = verified.select(F.col("a").alias("cid"), F.col("b_weight").alias("links")).unionByName(verified.select(F.col("b").alias("cid"), F.col("a_weight").alias("links"))) \
        .unionByName(stars.select(F.col("a").alias("cid"), "links")).groupBy("cid").agg(F.sum("links").alias("links"))
    return edges, links


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links, text_hash.

    ``component_id`` is the smallest id reachable by links, ``n_links`` the number of other
    documents within the threshold.  A document without words has no links and is its own
    component.  Null ids are compared like any other but name no component.  Repeated rows and
    equal texts link.  Texts of any length are taken whole; an empty table gives no rows.  Other columns,
    whatever their names, are not read.
    """
    docs = df.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    small_batches(df.sparkSession)
    rows = materialise(_measured(docs, words), "jaccard-rows")
    known = rows.filter("n > 0")
    classes = materialise(known.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("weight")), "jaccard-classes")
    # step 2: n - r >= ceil(percent * n / 100) is what the prefix of the first order asks
    unique = _unique_tokens(known, "h1", "h2")
    alive = classes.join(unique, ["h1", "h2"], "left").filter(100 * (F.col("n") - F.coalesce("r", F.lit(0))) >= percent * F.col("n"))
    # from here on a class has a number of its own
    alive = materialise(with_row_id(alive.select("h1", "h2", "n", "weight", "least_id", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("text_hash")), "cid"), "jaccard-alive")
    id_hash = lambda c: F.xxhash64(F.col(c)).alias("id_hash")
    firsts = alive.select("cid", "n", "weight", "first_id", "text_hash", id_hash("first_id"))
    texts = docs.select("*", F.xxhash64("text").alias("text_hash"), id_hash("doc_id")).join(_small(firsts), ["text_hash", "id_hash"]) \
        .filter(F.col("doc_id").eqNullSafe(F.col("first_id"))).dropDuplicates(["cid"])
    sets = materialise(_whole_sets(texts.select("cid", "n", "weight", "text"), words), "jaccard-sets")
    edges, links = similar_classes(sets, percent)
    roots = components(edges)
    joined = alive.select(F.col("cid").alias("node"), "h1", "h2", "least_id").join(roots, "node")
    named = joined.join(joined.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select(F.col("node").alias("cid"), "h1", "h2", "component_id")
    linked = named.join(links, "cid", "left").select("h1", "h2", "component_id", "links")
    found = materialise(classes.join(linked, ["h1", "h2"], "left").select(
        "h1", "h2", "weight", F.coalesce("component_id", "least_id").alias("component_id"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "jaccard-found")
    # documents of hot classes meet their class in place: at most HOT_SHARE classes are sent to all tasks
    own = rows.select("doc_id", "text_hash", "n", "h1", "h2")
    total = classes.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    hot = F.broadcast(found.filter(F.col("weight") * HOT_SHARE >= max(total, HOT_SHARE * HOT_SHARE)))
    some, set_of = own.filter("n > 0"), ["h1", "h2"]
    met = some.join(hot, set_of).unionByName(some.join(hot.select(*set_of), set_of, "left_anti").join(found, set_of))
    out = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", "text_hash"]
    alone = own.filter("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("n_links", F.lit(0).cast("long"))
    return met.withColumn("component_id", F.coalesce("component_id", "doc_id")).select(*out).unionByName(alone.select(*out))


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each component stays, the first row of its smallest id; all columns as they are.

    Documents without words all stay, and so do those that reach no id that is not null.
    """
    found = jaccard_join(df, id_col, text_col, **how).filter("n_shingles > 0 AND component_id IS NOT NULL")
    found = materialise(found.groupBy("component_id", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")), "jaccard-groups")
    key = F.xxhash64("doc_id", "text_hash").alias("_key")
    chosen = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("c"))
    chosen = found.join(chosen, "component_id").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("text_hash") == F.col("c.text_hash")))
    gone = materialise(chosen.filter(~F.col("stays")).select(key).distinct(), "jaccard-gone")
    repeated = materialise(chosen.filter(F.col("stays") & (F.col("rows") > 1)).select(key).distinct(), "jaccard-repeated")
    name = "_key"
    while name in df.columns:
        name += "_"
    keyed = df.withColumn(name, F.xxhash64(quoted(id_col), F.xxhash64(quoted(text_col))))
    stay = keyed.join(_small(gone.withColumnRenamed("_key", name)), name, "left_anti")
    again = _small(repeated.withColumnRenamed("_key", name))
    once = stay.join(again, name, "left_anti").unionByName(stay.join(again, name, "left_semi").dropDuplicates([name]))
    return once.select(*[quoted(c) for c in df.columns])


@register("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")
