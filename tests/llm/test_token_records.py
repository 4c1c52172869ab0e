from __future__ import annotations

import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tracksync.llm.common import read_table
from tracksync.llm.token_records import DamagedRecord, WordEncoder, frame, op8_token_records, pack, read_at, read_frame, read_records, tokenizer_config, unpack, write_records

ALPHABET = [" ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "a", "B", "the", "'s", "é", "é", "́", "Σ", "İ", "1", "!", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", ".", ",", "x.", "中", "🙂", "\x00"]


def test_word_by_word_like_the_library():
    rnd = random.Random(4)
    words, library = WordEncoder(tokenizer_config()), Tokenizer.from_str(tokenizer_config())
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 25))) for _ in range(1500)]
    for t, ids in zip(texts, words.encode(texts), strict=True):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_frames_find_damage():
    ids = np.array([1, 2, 49407], "<u4")
    for two in (True, False):
        assert unpack(pack(None, ids, two))[0] is None
        assert unpack(pack(-5, ids, two))[1].tolist() == [1, 2, 49407]
    data = frame(b"abc") + frame(b"")
    read = io.BytesIO(data).read
    assert [read_frame(read), read_frame(read), read_frame(read)] == [b"abc", b"", None]
    for k in range(len(frame(b"abc"))):
        wrong = bytearray(frame(b"abc"))
        wrong[k] ^= 1
        with pytest.raises(DamagedRecord):
            read_frame(io.BytesIO(bytes(wrong)).read)
    with pytest.raises(DamagedRecord):
        read_frame(io.BytesIO(data[:14]).read)


def test_round_trip_in_order(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(rnd.randint(-50, 500), " ".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 30))), "x") for _ in range(300)]
    rows += [(None, None, "y"), (None, "a", "y"), (3, "the " * 50_000, "z"), (4, None, "z"), (4, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(5)
    folder = f"file://{tmp_path}/records"
    manifest = write_records(df, folder, tokenizer_config())
    got = read_records(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")).orderBy("start").collect()
    library = Tokenizer.from_str(tokenizer_config())
    want = []
    for i, t, _ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["c"]) for r in got) == sorted(want)
    keys = [-10**9 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got]).tolist()][:-1]
    file = max(manifest.collect(), key=lambda r: r["records"])
    places = list(range(file["records"]))
    rnd.shuffle(places)
    drawn = read_at(folder, file["file"], places)
    line = read_at(folder, file["file"], sorted(places))
    assert [line[p][1].tolist() for p in places] == [d[1].tolist() for d in drawn]


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder = f"file://{tmp_path}/none"
    assert read_records(write_records(df, folder, tokenizer_config()), folder).count() == 0


def test_marks_in_texts_and_other_tokenizers():
    texts = ["a \x01 b\x01c \x01\x01 d", "\x01", "don't stop.\u00a0Now\u2003x", "e\u0301 \u0301e", "<|endoftext|>A <|b", "10% \u212bngstr\u00f6m", ""] + [f"word{i} {i}" for i in range(3000)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        config = tokenizer_config(name)
        words, library = WordEncoder(config), Tokenizer.from_str(config)
        assert words.by_word == (name == "word_bpe_49k.json")
        for t, ids in zip(texts, words.encode(texts), strict=True):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_query_on_the_table(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect())
    library, want, start = Tokenizer.from_str(tokenizer_config()), [], 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op8_token_records(spark, SMALL).collect())) == want
