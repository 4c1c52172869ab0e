from __future__ import annotations

import pickle
import random
import zlib

import numpy as np

from tracksync.llm import language_id as L
from tracksync.llm.common import read_table

SYLLABLES = {"aa": ["ka", "ko", "ki", "ku"], "bb": ["sch", "ung", "ße", "ein"], "cc": ["çé", "eau", "oi", "tre"]}


def text(lang, rnd, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def test_gradients_by_differences():
    net = L.ByteGRU(3, 4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, w = L.framed([b"abc", b"zb", b"hello"])
    labels, rng = np.array([0, 2, 1]), np.random.default_rng(0)
    _, grads = net.gradients(x, labels, w)
    for k, v in net.p.items():
        for _ in range(8):
            i = tuple(int(rng.integers(s)) for s in v.shape)
            if k.startswith("E"):
                i = (int(rng.choice([97, 98, 104, 32])), i[1])
            old = v[i]
            v[i] = old + 1e-5
            up, _ = net.gradients(x, labels, w)
            v[i] = old - 1e-5
            down, _ = net.gradients(x, labels, w)
            v[i] = old
            assert abs((up - down) / 2e-5 - grads[k][i]) < 1e-6


def test_remembered_labels_are_the_network_s():
    rnd = random.Random(1)
    net = L.ByteGRU(2, 4)
    who = L.Identifier(net, ["x", "y"])
    texts = [text("bb", rnd, 20) for _ in range(5)] + ["z" * 1000, "...", None]
    got = who.probabilities(texts)
    for t, p in zip(texts, got, strict=True):
        runs = L.RUN.findall(t.lower()) if t else []
        if not runs:
            assert p is None
            continue
        total, n = np.zeros(2), 0
        for run in runs:
            for s in L.sequences(run):
                x, w = L.framed([s])
                total += (net.forward(x) * w[:, :, None]).sum(axis=(0, 1))
                n += len(s)
        assert np.allclose(p, total / n, atol=1e-5)


def test_held_out_accuracy_and_edges(spark):
    rnd = random.Random(2)
    rows = [(i, text(lang, rnd, 30), lang, "s", 1.0) for i, lang in enumerate(rnd.choices(sorted(SYLLABLES), k=400))]
    rows += [(1000, None, "aa", "s", 1.0), (1001, "", "aa", "s", 1.0), (1002, "123 !? ", None, "s", 1.0), (1003, text("cc", rnd, 30_000), None, "s", 1.0),
             (1004, text("bb", rnd, 5), None, "s", 1.0), (1004, text("bb", rnd, 5), None, "s", 1.0), (None, "kakaka koki", "aa", "s", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    model = L.train(docs, docs_per_language=60, hidden=8)
    found = L.identify(docs, model).withColumn("held_out", L.held_out()).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    want = {i: lang for i, _, lang, _, _ in rows}
    held = [r for r in found if r["held_out"] and r["doc_id"] < 400]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in found if r["doc_id"] is not None)
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.97
    assert {by[i]["lang_pred"] for i in (1000, 1001, 1002)} == {"und"} and by[1003]["lang_pred"] == "cc" and by[1004]["lang_pred"] == "bb"
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id in (1000, 1001, 1002)").count() == 0
    assert L.identify(docs.filter("false"), model).count() == 0
    nothing = L.train(docs.filter("lang = 'zz'"))
    assert {r["lang_pred"] for r in L.identify(docs, nothing).collect()} == {"und"}


def test_numbers_that_are_no_digits_are_no_letters():
    who = pickle.loads(pickle.dumps(L.Identifier(L.ByteGRU(2, 4), ["a", "b"])))
    langs, scores = who.predict(["\u00bd \u00b2 \u2167", "12 \u00be", "x\u00b2y", "\u00bd a"])
    assert langs[:2] == ["und", "und"] and scores[:2] == [0.0, 0.0] and "und" not in langs[2:]
    assert L.letters("x\u00b2y\u2167") == ["x", "y"]
    assert who.probabilities(["x\u00b2y"])[0].tolist() == who.probabilities(["x y"])[0].tolist()


def test_query_on_the_table(spark):
    """The registered query: contract columns, and its accuracy on held-out documents."""
    folder = "/root/testdata/sf0.01"
    told = {r["doc_id"]: (r["text"], r["lang"]) for r in read_table(spark, folder, "documents").select("doc_id", "text", "lang").collect()}
    got = L.op10_language_id(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(told)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in told[r["doc_id"]][0] or "")) for r in got)
    judged = [r["lang_pred"] == told[r["doc_id"]][1] for r in got if r["held_out"] and r["lang_pred"] != "und" and told[r["doc_id"]][1]]
    assert len(judged) > 100 and sum(judged) >= 0.97 * len(judged)
