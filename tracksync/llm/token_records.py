"""Token ids in length-delimited binary records with an offset index.

A record is ``length u64 | check(length) u32 | payload | check(payload) u32``, little-endian;
a check is the CRC-32 of the bytes, rotated right by 15 bits plus a constant.  The payload is
``flags u8 | doc_id i64 | ids``: flag 1 says that doc_id is null, flag 2 that ids take two
bytes and not four (a vocabulary of up to 65,536).  Beside each data file an index file holds
``offset u64 | doc_id i64 | ids u32 | flags u32`` for every record, so a reader can draw
records in any order.  Files are ordered: every doc_id of a file is at most those of the next.

Tasks write to the folder named by the caller (any scheme pyarrow opens: local, hdfs, s3); a
repeated task attempt writes other file names, and only the files named in the manifest, a
Parquet table, belong to the data set.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracksync.session import scratch_path

from .common import held_by_worker, materialise, quoted, read_table, register

#: Fixed value of the mask.
MASK_DELTA = 0xA282EAD8
INDEX = np.dtype([("offset", "<u8"), ("doc_id", "<i8"), ("n", "<u4"), ("flags", "<u4")])
_HEAD, _NULL, _TWO_BYTES = struct.Struct("<Bq"), 1, 2
#: Words an encoder remembers, in two generations of this size.
CACHE_ENTRIES = 600_000


class DamagedRecord(ValueError):
    pass


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def read_frame(read) -> bytes | None:
    """The next payload of ``read(n)``, None at the end; a wrong check or a cut file raises."""
    head = read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise DamagedRecord("length of a record")
    size = struct.unpack("<Q", head[:8])[0]
    body = read(size + 4)
    if len(body) < size + 4 or struct.unpack("<I", body[size:])[0] != masked(body[:size]):
        raise DamagedRecord("payload of a record")
    return body[:size]


def packed(doc_id: int | None, ids: bytes, two_bytes: bool) -> bytes:
    """A payload of ids that are bytes already, two or four each."""
    flags = _NULL * (doc_id is None) | _TWO_BYTES * two_bytes
    return _HEAD.pack(flags, doc_id or 0) + ids


def pack(doc_id: int | None, ids: np.ndarray, two_bytes: bool) -> bytes:
    return packed(doc_id, ids.astype("<u2" if two_bytes else "<u4").tobytes(), two_bytes)


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u2" if flags & _TWO_BYTES else "<u4", offset=_HEAD.size)
    return None if flags & _NULL else doc_id, ids.astype("<u4")


#: What the word-by-word way relies on (fixed values of the tokenizer's file).
WORDWISE_NORMALISER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORDWISE_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class WordEncoder:
    """The library's ids of whole texts.

    For a tokenizer with the normaliser and splitter above, word by word: the normaliser turns every
    run of white space into one blank, which the splitter drops, so no token spans two words.  It also
    lower-cases, and the splitter parts a stop from the letter before it; so words that differ only in
    that share what is remembered.  Texts that hold the opening of an added token are not
    lower-cased here.  New words are encoded many at a time, as one text with a mark between words.
    Any other tokenizer encodes whole texts.
    """

    #: Marks that the splitter parts from an ASCII letter before them.
    STOPS = frozenset(b".,;:!?")
    LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")
    MARK = "\x01"

    def __init__(self, config: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(config)
        self.two_bytes = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.kind = "<u2" if self.two_bytes else "<u4"
        self.openings = {t.content.encode()[:2] for t in self.tokenizer.get_added_tokens_decoder().values()}
        told = json.loads(config)
        first = ((told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_word = told.get("normalizer") == WORDWISE_NORMALISER and not any(t.get("lstrip") or t.get("rstrip") for t in told.get("added_tokens") or []) and (
            first.get("type"), first.get("pattern"), first.get("behavior"), first.get("invert")) == ("Split", {"Regex": WORDWISE_PATTERN}, "Removed", True)
        mark = self._whole([self.MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, text: str) -> list[bytes]:
        data = text.encode()
        return (data if any(o in data for o in self.openings) else data.lower()).split()

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes; a token of the mark's ends nothing but the mark."""
        texts = [w.decode() for w in words]
        if self.mark is not None and not any(self.MARK in t for t in texts):
            ids = self._whole([f" {self.MARK} ".join(texts)])[0]
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) == len(words) - 1:
                data, width = ids.tobytes(), ids.itemsize
                begins, ends = [0, *((cut + 1) * width).tolist()], [*(cut * width).tolist(), len(data)]
                return [data[b:e] for b, e in zip(begins, ends, strict=True)]
        return [i.tobytes() for i in self._whole(texts)]

    def _add(self, words: set[bytes]) -> None:
        """Remember the ids of these words."""
        known, older, stopped, new = self.known, self.older, [], set()
        for w in words:
            if w in older:
                known[w] = older[w]
            elif len(w) > 1 and w[-1] in self.STOPS and w[-2] in self.LETTERS:
                stopped.append(w)
                new.update(x for x in (w[:-1], w[-1:]) if x not in known)
            else:
                new.add(w)
        for w in [w for w in new if w in older]:
            known[w] = older[w]
            new.discard(w)
        listed = list(new)
        for at in range(0, len(listed), 1024):
            some = listed[at:at + 1024]
            known.update(zip(some, self._encoded(some), strict=True))
        for w in stopped:
            known[w] = known[w[:-1]] + known[w[-1:]]

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian, two bytes each if the vocabulary allows, else four."""
        if not self.by_word:
            return [i.tobytes() for i in self._whole(texts)]
        if len(self.known) > CACHE_ENTRIES:  # what was not asked for since the last time goes
            self.older, self.known = self.known, {}
        known = self.known
        words = [self._words(t) for t in texts]
        self._add(set().union(*words).difference(known))
        return [b"".join(map(known.__getitem__, ws)) for ws in words]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(i, self.kind).astype("<u4") for i in self.encode_bytes(texts)]


def encoder(config: str) -> WordEncoder:
    """One encoder a worker, with what it remembers, for all its tasks."""
    return held_by_worker("words", hash(config), lambda: WordEncoder(config))


def _open(folder: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    return system, path.rstrip("/")


def write_records(df: DataFrame, folder: str, config: str, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts and write them in ascending ``id_col`` order (nulls first); returns the manifest.

    The manifest has one row per file: part, file, records, tokens, before (tokens in all
    earlier files).  Null texts are empty: only the end id.  Equal ids keep scan order, repeated rows
    each get their record.  A text of any length is one record.  An empty table gives an empty
    manifest.  Other columns, whatever their names, are not read.
    """
    spark = df.sparkSession
    held = spark.sparkContext.broadcast(config)
    rows = df.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"), F.monotonically_increasing_id().alias("_row"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_row").asc()]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at = encoder(held.value), TaskContext.get()
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{at.partitionId():06d}-{at.taskAttemptId()}"
        tail = b"" if end_id is None else np.array([end_id], words.kind).tobytes()
        width = 2 if words.two_bytes else 4
        offset = tokens = records = 0
        with system.open_output_stream(f"{base}/{name}.rec") as out, system.open_output_stream(f"{base}/{name}.idx") as beside:
            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    some = batch.slice(k, 256)
                    texts = words.encode_bytes([t or "" for t in some.column(1).to_pylist()])
                    frames, index = [], []
                    for doc_id, ids in zip(some.column(0).to_pylist(), texts, strict=True):
                        record = frame(packed(doc_id, ids + tail, words.two_bytes))
                        n = (len(ids) + len(tail)) // width
                        frames.append(record)
                        index.append((offset, doc_id or 0, n, _NULL * (doc_id is None)))
                        offset, tokens = offset + len(record), tokens + n
                    out.write(b"".join(frames))
                    beside.write(np.array(index, INDEX).tobytes())
                    records += len(index)
        if records:
            yield pa.RecordBatch.from_pydict({"part": [at.partitionId()], "file": [name], "records": [records], "tokens": [tokens]})

    manifest = materialise(ordered.mapInArrow(write, "part long, file string, records long, tokens long"), "record-files")
    line = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("before", F.coalesce(F.sum("tokens").over(line), F.lit(0)))


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Read every file of the manifest, one file a task, checks verified: doc_id, start, n_tokens, ids (binary, u32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start, out, size = row["before"], [], 0
                with system.open_input_stream(f"{base}/{row['file']}.rec", buffer_size=1 << 20) as data:
                    while (payload := read_frame(data.read)) is not None:
                        doc_id, ids = unpack(payload)
                        out.append((doc_id, start, len(ids), ids.tobytes()))
                        start, size = start + len(ids), size + len(ids)
                        if size > 1 << 19:
                            yield _rows(out)
                            out, size = [], 0
                if start != row["before"] + row["tokens"]:
                    raise DamagedRecord(f"{row['file']} is cut")
                if out:
                    yield _rows(out)

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                          names=["doc_id", "start", "n_tokens", "ids"])

    files = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartition(files, "file").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def read_at(folder: str, file: str, places: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Records of one file by their place in its index, in the order asked: the shuffled reader."""
    system, base = _open(folder)
    with system.open_input_file(f"{base}/{file}.idx") as f:
        index = np.frombuffer(f.read(), INDEX)
    out = []
    with system.open_input_file(f"{base}/{file}.rec") as f:
        for k in places:
            f.seek(int(index[k]["offset"]))
            out.append(unpack(read_frame(f.read)))
    return out


def tokenizer_config(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@register("op8_token_records")
def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-records")
    manifest = write_records(read_table(spark, sf_dir, "documents"), folder, tokenizer_config())
    return read_records(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
