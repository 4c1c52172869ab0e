from __future__ import annotations

import pickle
import re

import corpus_pipeline
import numpy as np
from test_jaccard import brute as brute_groups
from test_mixing import fill
from test_secrets import brute as brute_secrets

from tracksync.llm import language_id
from tracksync.llm.mixing import SEED
from tracksync.llm.pieces import PieceModel, model_bytes


def hidden(text):
    out, at = "", 0
    for s, _, e, _ in brute_secrets(text):
        if s >= at + (at > 0):
            out += text[at:s] + "[SECRET]"
            at = e
        elif s <= at and at:
            at = max(at, e)
        else:
            out += text[at:s] + "[SECRET]"
            at = e
    return out + text[at:]


def line(rows):
    import hashlib

    def key(r):
        size = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        tie = hashlib.md5(f"{SEED}:{r['doc_id']}".encode()).hexdigest()
        return int(np.floor(np.sqrt(size))), size, tie, r

    return sorted((key(r) for r in rows), key=lambda k: k[:3])


def test_run_like_brute_force(spark, tmp_path, monkeypatch):
    import hashlib

    models = []
    train = language_id.train
    monkeypatch.setattr(language_id, "train", lambda *a, **k: models.append(train(*a, **k)) or models[-1])
    src = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(9000, None, "en", "src0", 0), (9001, "", "en", "src0", 0), (9002, "123 !", None, None, 5),
                                   (9003, "the password=abcdefghijklm and the of in that was here with others", "en", None, 60)], src.schema)
    docs = src.unionByName(extra).unionByName(src.limit(3))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    rows = [r.asDict() for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    who = pickle.loads(models[0])
    rows = [r for r in rows for langs, scores in [who.predict([r["text"]])] if langs[0] != "und" and scores[0] >= 0.3]
    groups = dict((d, c) for d, _, c, _ in brute_groups([(r["doc_id"], r["text"]) for r in rows], 5, 80))
    first: dict = {}
    for r in rows:
        if groups[str(r["doc_id"])] == str(r["doc_id"]):
            first.setdefault(r["doc_id"], r)
    rows = [{**r, "text": hidden(r["text"])} for r in first.values()]
    by: dict = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sizes = {s: sum(k[1] for k in line(own)) for s, own in by.items()}
    targets = fill(sizes)
    model, want = PieceModel(model_bytes()), []
    for s, own in by.items():
        u = int(hashlib.md5(f"{SEED}|{chr(0) + 'null' if s is None else s}".encode()).hexdigest()[:8], 16) / 2**32
        rate = targets[s] / sizes[s]
        for k, (_, _, _, r) in enumerate(line(own), 1):
            for _ in range(int(np.floor(rate * k + u) - np.floor(rate * (k - 1) + u))):
                want.append((r["doc_id"], model.encode(r["text"])[0].tobytes()))
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in got) == sorted(want)
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in got)


def test_stages_keep_the_columns_and_stand_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, `a.b` int"
    docs = spark.createDataFrame([(i, f"the cat number{i} sat on mat{i} and then went home {i}", "en", "s", 1, 2, 3) for i in range(30)], schema)
    for frame in (docs, docs.filter("false")):
        now = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, "")
            assert now.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() == now.count()


def test_near_copies_by_five_words_and_four_fifths(spark):
    src = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    long, short = [f"a{i}" for i in range(53)], [f"b{i}" for i in range(40)]
    texts = [long, [*long[:26], "x", *long[27:]], short, [*short[:20], "x", *short[21:]]]  # 44/54 and 31/41 of five words, 48/54 and 35/41 of three
    docs = src.unionByName(spark.createDataFrame([(9100 + i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)], src.schema))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert [d for d in got if d >= 9100] == [9100, 9102, 9103]
    assert got == sorted(int(d) for d, n, c, _ in brute_groups(rows, 5, 80) if not n or d == c)
