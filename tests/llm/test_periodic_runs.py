"""Periodic runs: extensions against word by word comparison, runs and digests against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL
from tracksync.llm.common import read_table
from tracksync.llm.periodic_runs import CoverSuffixes, difference_cover, find_runs, looped, op13_periodic_runs, periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period): for each distance the longest stretches of equal pairs."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_covers_hold_every_difference():
    for r in range(4):
        v, cover = difference_cover(r)
        assert len(cover) == 6 * r + 4 and {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_extensions_equal_comparison():
    rng = np.random.default_rng(3)
    for size, kinds in ((1, 1), (5, 2), (300, 1), (700, 2), (900, 400)):
        words = rng.integers(1, kinds + 1, size).astype(np.int32)
        words[size // 2:size // 2 + size // 3] = words[:size // 3]
        index = CoverSuffixes(words)
        i, j = rng.integers(0, size + 1, (2, 500))
        i, j = i[i != j], j[i != j]
        for a, b, got in zip(i.tolist(), j.tolist(), index.lce(i, j).tolist(), strict=True):
            same = 0
            while max(a, b) + same < size and words[a + same] == words[b + same]:
                same += 1
            assert got == same


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=12), st.integers(1, 30)), max_size=8), st.sampled_from([(24, 3), (6, 3), (8, 2)]))
def test_runs_equal_brute_force(parts, law):
    docs = [[w for part, times in parts[k:] for w in part * times] for k in range(3)]
    sizes = np.array([len(d) for d in docs])
    offsets = np.cumsum(sizes + 1) - sizes - 1
    flat = np.array([w for k, d in enumerate(docs) for w in [*d, 10 + k]], np.int32)
    start, end, period = find_runs(flat, offsets, sizes, *law)
    for o, n, doc in zip(offsets, sizes, docs, strict=True):
        own = (start >= o) & (start < o + n)
        assert list(zip((start - o)[own].tolist(), (end - start)[own].tolist(), period[own].tolist(), strict=True)) == brute_runs(doc, *law)


def test_query_on_the_table_like_brute_force(spark):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op13_periodic_runs(spark, SMALL).collect())
    want = sorted(brute_row(*d) for d in docs)
    assert got == want and sum(r[1] > 0 for r in got) >= 10


def test_edges(spark):
    long = " ".join(["x"] * 30_000) + " " + " ".join(f"w{i % 7000}" for i in range(21_500))
    rows = [(None, "a b " * 20, 1), (2, None, 1), (3, "", 1), (4, " \t\n", 1), (5, "a " * 24, 1), (5, "a " * 24, 1), (6, "a " * 23, 1), (7, long, 1), (8, "é\u00a0ü " * 30, 1), (9, "one", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = [tuple(r) for r in periodic_runs(df).select("doc_id", "n_words", "runs", "collapsed").collect()]
    as_rows = {(g[0], g[1]): ([tuple(r) for r in g[2]], g[3]) for g in got}
    assert len(got) == len(rows)
    assert as_rows[None, 40] == ([(0, 40, 2)], "a b")
    assert as_rows[2, 0] == as_rows[3, 0] == as_rows[4, 0] == ([], "")
    assert as_rows[5, 24] == ([(0, 24, 1)], "a") and sum(g[0] == 5 for g in got) == 2
    assert as_rows[6, 23][0] == [] and as_rows[9, 1] == ([], "one")
    assert as_rows[7, 51_500][0] == [(0, 30_000, 1), (30_000, 21_500, 7000)]
    assert as_rows[8, 30] == ([(0, 30, 1)], "é\u00a0ü")
    assert periodic_runs(df.limit(0)).collect() == []
    assert looped(None, 5) is None


def test_plan_is_one_narrow_pass(spark, tmp_path):
    plan = op13_periodic_runs(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
