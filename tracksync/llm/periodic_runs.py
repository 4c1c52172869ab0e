"""Periodic runs of words: maximal stretches that repeat with some period.

A run of period q is a stretch in which words q apart are equal, q the smallest such distance,
long enough, and not to be extended on either side.  A run of length ``max(least, times * q)``
or more holds a pair (i, i + q) of equal words for some ``i`` on any grid of step
``max(least, times * q) - q``; the grids of all periods have about ``n log n / 2`` points (a
harmonic sum).  The few that survive a look at the words beside them are extended to both
sides by longest-common-extension queries:

* the suffixes at the positions of a difference cover are sorted, and no others.  A difference
  cover modulo v of about sqrt(1.5 v) residues holds, for any two positions, a shift below v
  that takes both to sampled positions;
* a query compares words up to that shift, then reads the rest as a range minimum, in a sparse
  table over the common prefixes of neighbours in suffix order;
* backward extensions are queries over the reversed words.

One narrow pass: a task works on its own documents, some at a time, laid end to end between
separators that occur once.  Words are compared exactly; nothing is hashed.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, read_table, register

#: Words worked on at once (one document, if it has more).
WORDS_AT_ONCE = 1 << 17
_POINTS = 1 << 20
_GATHER = 1 << 20


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """(v, cover): 6r + 4 residues modulo v = 24r^2 + 36r + 13 whose differences are all residues."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.cumsum([0, *steps])


class CoverSuffixes:
    """Longest common extensions in ``words`` (int32, all positive) by sorted cover-sampled suffixes."""

    def __init__(self, words: np.ndarray, r: int = 1):
        self.v, cover = difference_cover(r)
        self.size = len(words)
        self.text = np.concatenate([words, np.zeros(2 * self.v + 1, words.dtype)])
        slot = np.full(self.v, -1)
        slot[cover] = np.arange(len(cover))
        self.slot, self.per = slot, len(cover)
        inside = slot >= 0
        both = np.stack([np.roll(inside, -d)[:, None] & np.roll(inside, -d)[None, :] for d in range(self.v)])
        self.shift = both.argmax(axis=0)  # the least shift that takes two residues into the cover
        self._sort()

    def _sort(self) -> None:
        at = (np.arange(0, self.size + 1, self.v)[:, None] + np.flatnonzero(self.slot >= 0)).ravel()
        self.at = at = at[at <= self.size]
        count = len(at)
        blocks = np.lib.stride_tricks.sliding_window_view(self.text, self.v)[at]
        rank = np.unique(np.ascontiguousarray(blocks).view(f"S{4 * self.v}").ravel(), return_inverse=True)[1].ravel() + 1
        levels, ahead = [rank], self.per
        while rank.max(initial=0) < count:
            after = np.zeros(count, np.int64)
            after[:max(0, count - ahead)] = rank[ahead:]
            rank = np.unique(rank * (count + 1) + after, return_inverse=True)[1].ravel() + 1
            levels.append(rank)
            ahead *= 2
        self.rank = rank - 1
        order = np.argsort(rank)
        # common prefixes of neighbours: equal blocks from the longest down, then single words
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(count - 1, np.int64)
        for level in range(len(levels) - 1, -1, -1):
            held = np.append(levels[level], [0])
            far = self.per << level
            same = (a < count) & (b < count) & (held[np.minimum(a, count)] == held[np.minimum(b, count)])
            a, b = np.where(same, a + far, a), np.where(same, b + far, b)
            common += np.where(same, self.v << level, 0)
        first, second = at[order[:-1]] + common, at[order[1:]] + common
        common += self._equal_words(first, second)
        self.table = [common.astype(np.int32)]
        while (1 << len(self.table)) <= len(common):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _equal_words(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most v."""
        out, near = np.zeros(len(i), np.int64), np.arange(self.v)
        last = len(self.text) - 1
        rows = max(1, _GATHER // self.v)
        for at in range(0, len(i), rows):
            a, b = i[at:at + rows, None] + near, j[at:at + rows, None] + near
            differ = self.text[np.minimum(a, last)] != self.text[np.minimum(b, last)]
            out[at:at + rows] = np.where(differ.any(axis=1), differ.argmax(axis=1), self.v)
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and from j on; i < j or i > j, both at most the length."""
        shift = self.shift[i % self.v, j % self.v]
        out = self._equal_words(i, j)
        far = np.flatnonzero(out >= shift)
        a, b = i[far] + shift[far], j[far] + shift[far]
        a, b = (self.rank[x // self.v * self.per + self.slot[x % self.v]] for x in (a, b))
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(float))[1] - 1
        least = np.empty(len(far), np.int64)
        for k in np.unique(level):
            some = level == k
            least[some] = np.minimum(self.table[k][lo[some]], self.table[k][hi[some] - (1 << int(k))])
        out[far] = shift[far] + least
        return out


def _grid(offsets: np.ndarray, sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, q): for every document and period, one point of each stretch that a run's equal pairs fill."""
    periods = np.where(sizes >= least, sizes // times, 0)
    first = np.cumsum(periods) - periods
    total = int(periods.sum())
    for at in range(0, total, _POINTS):
        entry = np.arange(at, min(total, at + _POINTS))
        doc = np.searchsorted(first, entry, side="right") - 1
        q = entry - first[doc] + 1
        step = np.maximum(least, times * q) - q
        points = -(-(sizes[doc] - q) // step)
        ends = np.cumsum(points)
        begin = 0
        while begin < len(entry):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _POINTS, side="right")))
            some = slice(begin, stop)
            n = points[some]
            which = np.repeat(np.arange(len(n)), n)
            k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            yield offsets[doc[some]][which] + k * step[some][which], q[some][which]
            begin = stop


def find_runs(words: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start, then period.

    ``words`` holds all documents' word numbers (positive), each followed by a number that
    occurs once; ``offsets`` and ``sizes`` say where documents begin and how long they are.
    """
    text = np.concatenate([words, np.zeros(2, words.dtype)])
    # equal pairs of a run fill at least `fill` neighbouring places, so half of that on one side of a grid point
    q = np.arange(1, least + 1)
    fill = int((np.maximum(least, times * q) - q).min())
    half = max(1, min(8, fill // 2))
    near_i, near_q = [], []
    for i, q in _grid(offsets, sizes, least, times):
        some = np.flatnonzero(text[i] == text[i + q])
        i, q = i[some], q[some]
        ahead = back = np.arange(len(i))
        for k in range(1, half):
            ahead = ahead[text[np.minimum(i[ahead] + k, len(words))] == text[np.minimum(i[ahead] + q[ahead] + k, len(words) + 1)]] if len(ahead) else ahead
            back = back[i[back] >= k]
            back = back[text[i[back] - k] == text[i[back] + q[back] - k]]
        some = np.union1d(ahead, back)
        near_i.append(i[some])
        near_q.append(q[some])
    i = np.concatenate(near_i) if near_i else np.zeros(0, np.int64)
    q = np.concatenate(near_q) if near_q else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    if not len(i):
        return none, none, none
    # the documents of the points left, alone
    doc = np.searchsorted(offsets, i, side="right") - 1
    held = np.unique(doc)
    size = sizes[held] + 1
    moved = np.cumsum(size) - size
    part = words[np.repeat(offsets[held] - moved, size) + np.arange(int(size.sum()))]
    away = (offsets[held] - moved)[np.searchsorted(held, doc)]
    ahead, back = CoverSuffixes(part), CoverSuffixes(part[::-1].copy())
    found = []
    for at in range(0, len(i), _POINTS):
        a, p = (i - away)[at:at + _POINTS], q[at:at + _POINTS]
        start = a - back.lce(len(part) - a, len(part) - a - p)
        end = a + p + ahead.lce(a, a + p)
        whole = end - start >= np.maximum(least, times * p)
        one = np.stack([start[whole] + away[at:at + _POINTS][whole], end[whole] + away[at:at + _POINTS][whole], p[whole]])
        found.append(np.unique(one, axis=1))
    start, end, p = np.unique(np.concatenate(found, axis=1), axis=1)
    # a stretch found with multiples of its smallest period is one run
    first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else np.zeros(0, bool)
    start, end, p = start[first], end[first], p[first]
    order = np.lexsort((p, start))
    return start[order], end[order], p[order]


class _Numbers(dict):
    """Numbers words from 1 as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def _runs_of(texts: list[list[bytes]], least: int, times: int) -> tuple[list[list[dict]], list[bytes]]:
    """Each document's runs and its words without those after a run's first period, joined by one space."""
    numbers = _Numbers()
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.cumsum(sizes + 1) - sizes - 1
    words = np.zeros(int(sizes.sum()) + len(texts), np.int32)
    for o, t in zip(offsets.tolist(), texts, strict=True):
        words[o:o + len(t)] = list(map(numbers.__getitem__, t))
    words[offsets + sizes] = np.arange(len(texts)) + len(numbers) + 1
    start, end, period = find_runs(words, offsets, sizes, least, times)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    gone = np.cumsum(edge) > 0
    runs: list[list[dict]] = [[] for _ in texts]
    doc = np.searchsorted(offsets, start, side="right") - 1
    for d, s, e, p in zip(doc.tolist(), (start - offsets[doc]).tolist(), (end - offsets[doc]).tolist(), period.tolist(), strict=True):
        runs[d].append({"start": s, "length": e - s, "period": p})
    collapsed = []
    for d, t in enumerate(texts):
        if runs[d]:
            dropped = gone[offsets[d]:offsets[d] + len(t)]
            t = [t[k] for k in np.flatnonzero(~dropped).tolist()]
        collapsed.append(b" ".join(t))
    return runs, collapsed


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, times: int = 3,
                  rewrite: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    Words are runs of characters other than ASCII white space.  ``collapsed`` is the text's words
    joined by one space, without those that stand in a run after its first period.
    ``rewrite(id, n)`` may give an array of word numbers that replaces a text of n words before the
    search.  A null text has no words and an empty ``collapsed``, like an empty one; a null id is
    passed on.  Repeated rows each get their row; of equally long stretches each is a run of its
    own.  An empty table gives no rows.  Very long texts are worked on whole, alone in their
    batch.  Other columns are not read.
    """
    if least < 2 * times or times < 2:
        raise ValueError("times must be 2 or more, least 2 * times or more")

    def work(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs, collapsed = _runs_of(texts, least, times)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array([len(t) for t in texts], pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
                                          names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            ids, texts, held, begin = column.to_pylist(), [], 0, 0
            data = batch.column(1)
            for row in range(batch.num_rows):
                words = (data[row].as_py() or b"").split()
                if rewrite is not None and words:
                    other = rewrite(ids[row], len(words))
                    if other is not None:
                        words = [words[k] for k in other.tolist()]
                texts.append(words)
                held += len(words)
                if held >= WORDS_AT_ONCE or row + 1 == batch.num_rows:
                    yield work(column.slice(begin, len(texts)), texts)
                    texts, held, begin = [], 0, row + 1

    kind = df.select(quoted(id_col)).schema[0].dataType.simpleString()
    return df.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def looped(doc_id: object, n: int) -> np.ndarray | None:
    """The word numbers of a text whose tail is replaced by a loop of its own words, for a tenth of all ids."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read_table(spark, sf_dir, "documents"), rewrite=looped)
    # greater length / period in whole numbers; runs come by start, then period, so the first of equals stays
    stronger = lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), stronger)
    line = lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n"))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
