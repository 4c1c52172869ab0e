from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tracksync.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    covered = set()
    for i in range(len(words) - 2):
        for j in range(len(words) - 2):
            if i != j and words[i:i + 3] == words[j:j + 3]:
                covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_measures_like_brute_force():
    rnd = random.Random(1)
    for _ in range(400):
        t = "".join(rnd.choice(["a", "b", " ", " ", "\n", "\t", "#", "é", "🙂", "\xa0", "\x1c", "A1"]) for _ in range(rnd.randint(0, 60)))
        assert Q.measure(t)[:5] == brute(t), repr(t)
    assert Q.measure(None) == Q.measure("") and Q.measure("")[:5] == (0, 0, 0, 0, 0)


def test_learns_a_planted_conjunction():
    rng = np.random.default_rng(2)
    x = rng.random((4000, 3))
    bad = ((x[:, 0] > 0.7) & (x[:, 1] <= 0.4)) | (x[:, 2] > 0.9)
    rules = Q.learn(x[:3000], bad[:3000], ["a", "b", "c"])
    hit = np.zeros(1000, bool)
    for r in rules.rules:
        hit |= Q._fits(r, ["a", "b", "c"], x[3000:])
    assert (hit == bad[3000:]).mean() > 0.97
    assert Q.learn(x, np.zeros(4000, bool), ["a", "b", "c"]).rules == []
    assert Q.learn(x, np.ones(4000, bool), ["a", "b", "c"]).rules == []
    assert Q.learn(np.zeros((0, 3)), np.zeros(0, bool), ["a", "b", "c"]).rules == []


def test_frame_edges_and_list(spark):
    junk = "### buy $$$ now *** " * 30
    clean = " ".join(f"word{i} text" for i in range(60))
    rows = [(i, junk + str(i) if i % 3 == 0 else clean + f" {i}", 5) for i in range(300)] + [(None, None, 1), (900, "", 1), (900, "", 1), (901, clean * 2000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(200)] + [(250, None, 0)], "doc_id long, quality int, kept int")
    measured = Q.text_statistics(docs)
    assert measured.count() == len(rows)
    rules = Q.learn_from(measured, labels)
    assert rules.describe()
    got = {r["doc_id"]: r for r in Q.judge(measured, rules).collect()}
    assert got[None]["base_failed"] and not got[900]["kept"]
    assert all(got[i]["kept"] == (i % 3 != 0) for i in range(200, 300))
    assert got[901]["n_words"] > 100_000 and got[901]["base_failed"]
    none = Q.learn_from(measured, labels.filter("false"))
    assert none.rules == [] and Q.judge(measured, none).filter(F.col("kept") != ~F.col("base_failed")).count() == 0
    assert Q.judge(Q.text_statistics(docs.filter("false")), rules).count() == 0
