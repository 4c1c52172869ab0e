from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracksync.llm import jaccard as J
from tracksync.llm.components import components


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}


def brute(rows, k=3, percent=90):
    sets = [shingles(t, k) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((str(d), len(sets[i]), str(min(ids) if ids else None), links[i]))
    return sorted(out)


def corpus(seed, n, size, edits):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["the", "of", "and"]) if rnd.random() < 0.3 else "w%d" % rnd.randint(0, 3000)
    passage = [word() for _ in range(20)]
    base = [[word() for _ in range(rnd.randint(*size))] for _ in range(n)]
    out = []
    for b in base:
        for _ in range(rnd.choice([1, 1, 2, 6])):
            c = list(b)
            for _ in range(rnd.randint(0, edits)):
                c[rnd.randrange(len(c))] = word()
            if rnd.random() < 0.4:
                c += passage
            out.append(" ".join(c) if rnd.random() < 0.8 else "  ".join(c).upper())
    return out


def check(spark, rows, **how):
    df = spark.createDataFrame([(i, t, 5, 6, "x") for i, t in rows], "doc_id long, text string, n long, cid long, tokens string").repartition(3)
    got = J.jaccard_join(df, **how).select("doc_id", "n_shingles", "component_id", "n_links").collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in got) == brute(rows, how.get("words", 3), how.get("percent", 90))
    return df


def test_like_brute_force_with_small_buckets(spark):
    texts = corpus(1, 60, (1, 80), 4) + [None, "", " \n", "a", "A", "a b", "b a", "a b", "é É", "é é"]
    check(spark, [(i * 7 % 1000, t) for i, t in enumerate(texts)])


def test_like_brute_force_with_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BUCKET", 3)
    monkeypatch.setattr(J, "BLOCK", 4)
    texts = corpus(2, 12, (30, 90), 3)
    rnd = random.Random(3)
    base = texts[0].split()
    for _ in range(60):
        c = list(base)
        for _ in range(rnd.randint(1, 4)):
            c[rnd.randrange(len(c))] = rnd.choice(["x1", "x2", "x3", f"y{rnd.randint(0, 99)}"])
        texts.append(" ".join(c))
    check(spark, list(enumerate(texts)))


def test_other_threshold_ids_repeats_and_long_text(spark):
    texts = corpus(4, 15, (10, 40), 6)
    rows = list(enumerate(texts)) + [(3, texts[3])] * 2 + [(None, texts[0]), (None, "lonely words here"), (900, "long " + " ".join(f"z{i}" for i in range(40_000)))]
    rows.append((901, rows[-1][1] + " end"))
    df = check(spark, rows, words=2, percent=60)
    kept = J.keep_one_of_each(df, words=2, percent=60)
    assert kept.columns == df.columns
    ids = [str(r[0]) for r in kept.select("doc_id").collect()]
    want = {c for _, n, c, _ in brute(rows, 2, 60) if n and c != "None"}
    named = [i for i in ids if i != "None"]
    assert len(named) + ids.count("None") >= len(want) and len(set(named)) == len(named)
    assert len(ids) == len(want) + 1  # and the null id that reaches no other


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_join(df).count() == 0
    assert J.keep_one_of_each(df).count() == 0


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    rnd = random.Random(5)
    text = " ".join("w" * rnd.randint(1, 9) + str(rnd.random()) for _ in range(3000))
    whole = J.shingle_sets([text, text.upper(), ""], 3)
    monkeypatch.setattr(J, "_PIECE", 64)
    cut = J.shingle_sets(["zz", text], 3)
    assert np.array_equal(whole[0], cut[1]) and np.array_equal(whole[0], whole[1]) and len(whole[2]) == 0
    assert len(whole[0]) == len(shingles(text, 3))


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randint(-200, 200), rnd.randint(-200, 200)) for _ in range(150)] + [(i, i + 1) for i in range(500, 540)] + [(900, i) for i in range(901, 960)]
    roots: dict = {}

    def find(x):
        while roots.setdefault(x, x) != x:
            x = roots[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            roots[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r[0], r[1]) for r in got.collect()} == {(x, find(x)) for x in list(roots)}
    assert got.count() == got.select(F.countDistinct("node")).first()[0]
