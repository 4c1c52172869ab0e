"""Offset-preserving SentencePiece encoding and decoding.

The model file is read once and broadcast.  ``PieceModel.normalise`` rewrites a text by the
longest prefix that the compiled character map knows, position by position, and records for
every byte of the result which source bytes it stands for; white space becomes the marker
piece and gets its prefix.  The byte-pair merges of the vocabulary then cut the result into
pieces (a character outside the vocabulary falls back to byte pieces), and every piece is
projected to the span of UTF-8 bytes of the original text.

Merges never join two characters that stand side by side in no piece of the vocabulary, so
the text is cut there first; what lies between is merged once and remembered, in
two generations of up to ``CACHE_ENTRIES`` entries a worker.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_by_worker, quoted, read_table, register, small_batches

MARK = "▁"
# Fixed values of the model format: piece kinds and the model kind.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2

CACHE_ENTRIES = 250_000


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            if wire == 2:
                size, at = _varint(data, at)
            elif wire in (1, 5):
                size = 8 if wire == 1 else 4
            else:
                raise ValueError(f"wire type {wire} in the model file")
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def read_character_map(blob: bytes) -> dict[bytes, bytes]:
    """All rules of a compiled character map: a double-array trie, then NUL-ended results."""
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units, results = np.frombuffer(blob, "<u4", size // 4, 4).tolist(), blob[4 + size:]
    rules: dict[bytes, bytes] = {}
    child = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
    stack = [(child(units[0]), b"")]
    while stack:
        base, prefix = stack.pop()
        for byte in range(1, 256):
            at = base ^ byte
            if at < len(units) and units[at] & 0x800000FF == byte:
                key, below = prefix + bytes([byte]), at ^ child(units[at])
                if units[at] >> 8 & 1:
                    begin = units[below] & 0x7FFFFFFF
                    rules[key] = results[begin:results.index(b"\0", begin)]
                stack.append((below, key))
    return rules


def _byte_by_byte(err: UnicodeDecodeError):
    return "�", err.start + 1


codecs.register_error("each_byte", _byte_by_byte)


class _Remembered(dict):
    """A bounded map that makes what it lacks.  When it is full, what was not asked for since
    the last time goes; long keys are made each time."""

    def __init__(self, make, longest: int = 40):
        super().__init__()
        self.make, self.longest, self.older = make, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceModel:
    """A BPE model file.  Pieces are (id, normalised byte length) pairs of unsigned 32-bit integers."""

    def __init__(self, data: bytes):
        self.add_prefix = self.escape = self.trim = True
        kind, self.unknown, self.bos, self.eos, self.fallback, self.unknown_text = 1, 0, 1, 2, False, " ⁇ "
        pieces, rules = [], b""
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                kind, self.fallback = spec.get(3, 1), bool(spec.get(35, 0))
                self.unknown, self.bos, self.eos = spec.get(40, 0), spec.get(41, 1), spec.get(42, 2)
                self.unknown_text = spec.get(44, " ⁇ ".encode()).decode()
                if spec.get(24):
                    raise ValueError("white space as a suffix is not supported")
            elif number == 3:
                spec = dict(_fields(value))
                rules, self.add_prefix, self.trim, self.escape = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
        if kind != BPE or not self.escape or any(k in (USER_DEFINED, UNUSED) for _, _, k in pieces):
            raise ValueError("a BPE model with escaped white space and neither user-defined nor unused pieces is asked for")
        self.pieces = pieces
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.scores = {p: s for p, s, k in pieces if k == NORMAL}
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.surface = [self._surface(i) for i in range(len(pieces))]
        self.rules = {k.decode(): v.decode() for k, v in read_character_map(rules).items()}
        if self.rules:
            by_first: dict[str, list[str]] = {}
            for k in self.rules:
                by_first.setdefault(k[0], []).append(k)
            self.by_first = {c: sorted(ks, key=len, reverse=True) for c, ks in by_first.items()}
        self.words = _Remembered(lambda w: self.cut(MARK + w))
        self.parts = _Remembered(self.merge)
        self.runs = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def _surface(self, i: int) -> bytes:
        piece, _, kind = self.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b""
        return (self.unknown_text if kind == UNKNOWN else piece.replace(MARK, " ")).encode()

    # -- normalisation ------------------------------------------------------------------

    def _mapped(self, text: str) -> list[tuple[str, int]]:
        """(result, source bytes) steps: the longest known prefix, else one character."""
        out, at, size = [], 0, len(text)
        while at < size:
            key = next((k for k in self.by_first.get(text[at], ()) if text.startswith(k, at)), None)
            if key is None:
                out.append((text[at], len(text[at].encode())))
                at += 1
            else:
                out.append((self.rules[key], len(key.encode())))
                at += len(key)
        return out

    def normalise(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """The normalised text with white space marked, and for each of its bytes the source bytes [from, to)."""
        if not self.rules and not self.trim:
            raw = np.frombuffer(text.encode(), np.uint8)
            width = np.where(raw == 32, 3, 1)
            begin = np.repeat(np.arange(len(raw), dtype=np.uint32), width)
            end, marked = begin + np.uint32(1), text.replace(" ", MARK)
        else:
            steps = self._mapped(text) if self.rules else [(c, len(c.encode())) for c in text]
            flat = [(c, n) for c, n in steps]
            begins, at = [], 0
            for _, n in flat:
                begins.append(at)
                at += n
            units = [(r, b, b + n) for (r, n), b in zip(flat, begins, strict=True) if r]
            if self.trim:
                units = self._trimmed(units)
            marked = "".join(r for r, _, _ in units).replace(" ", MARK)
            width = [len(r.replace(" ", MARK).encode()) for r, _, _ in units]
            begin = np.repeat(np.array([b for _, b, _ in units], np.uint32), width)
            end = np.repeat(np.array([e for _, _, e in units], np.uint32), width)
        if marked and self.add_prefix:
            first = begin[:1].repeat(3)
            marked, begin, end = MARK + marked, np.concatenate([first, begin]), np.concatenate([first, end])
        return marked, begin, end

    @staticmethod
    def _trimmed(units: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """No leading or trailing spaces, and one of each run of them."""
        out: list[tuple[str, int, int]] = []
        for r, b, e in units:
            kept = []
            for c in r:
                last = kept[-1] if kept else out[-1][0][-1] if out else " "
                if c != " " or last != " ":
                    kept.append(c)
            if kept:
                out.append(("".join(kept), b, e))
        while out and out[-1][0].endswith(" "):
            r, b, e = out.pop()
            if r.rstrip(" "):
                out.append((r.rstrip(" "), b, e))
        return out

    # -- merging ------------------------------------------------------------------------

    def cut(self, chunk: str) -> bytes:
        """Pieces of a chunk: cut wherever no piece of the vocabulary can span."""
        pairs, begin, out = self.pairs, 0, []
        for i in range(1, len(chunk)):
            if chunk[i - 1:i + 1] not in pairs:
                out.append(self.parts[chunk[begin:i]])
                begin = i
        out.append(self.parts[chunk[begin:]])
        return b"".join(out)

    def merge(self, part: str) -> bytes:
        if part in self.ids and len(part) == 1:
            symbols = [part]
        elif len(part) <= 48:
            symbols = self._merge_short(part)
        else:
            symbols = self._merge_long(part)
        flat: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                flat += (i, len(s.encode()))
            elif self.fallback:
                for b in s.encode():
                    flat += (self.bytes[b], 1)
            else:
                flat += (self.unknown, len(s.encode()))
        return struct.pack(f"<{len(flat)}I", *flat)

    def _merge_short(self, part: str) -> list[str]:
        """Best score first, leftmost of equals: a scan for each merge."""
        score, none = self.scores.get, -1e30
        symbols = list(part)
        ranks = [score(a + b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
        while ranks:
            best = max(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = score(symbols[i - 1] + symbols[i], none)
            if i < len(ranks):
                ranks[i] = score(symbols[i] + symbols[i + 1], none)
        return symbols

    def _merge_long(self, part: str) -> list[str]:
        """The same order from a heap over linked symbols."""
        score = self.scores.get
        symbols: list[str | None] = list(part)
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(symbols):
                s = score(symbols[i] + symbols[j])
                if s is not None:
                    heapq.heappush(heap, (-s, i, j, symbols[i] + symbols[j]))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, made = heapq.heappop(heap)
            if symbols[i] is None or symbols[j] is None or after[i] != j or symbols[i] + symbols[j] != made:
                continue
            symbols[i], symbols[j] = made, None
            after[i] = after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in symbols if s is not None]

    # -- whole texts --------------------------------------------------------------------

    def encode(self, text: str, ends: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) and an array of [from, to) source byte spans; begin and end ids have empty spans."""
        marked, begin, end = self.normalise(text)
        if not marked:
            packed = b""
        elif not self.by_word:
            packed = self.cut(marked)
        else:
            words = marked[1:].split(MARK) if marked[0] == MARK else None
            if words and all(words):
                packed = b"".join(map(self.words.__getitem__, words))
            else:
                packed = b"".join(map(self.cut, self.runs.findall(marked)))
        table = np.frombuffer(packed, "<u4").reshape(-1, 2)
        ids, to = table[:, 0], np.cumsum(table[:, 1], dtype=np.int64)
        spans = np.empty((len(ids), 2), "<u4")
        if len(ids):
            spans[:, 0], spans[:, 1] = begin[to - table[:, 1]], end[to - 1]
        if ends:
            last = len(text.encode())
            ids = np.concatenate([[self.bos], ids, [self.eos]])
            spans = np.concatenate([[[0, 0]], spans, [[last, last]]])
        return ids.astype("<u4"), spans.astype("<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; a byte that is no part of a character gives U+FFFD."""
        surface, listed = self.surface, ids.tolist()
        data = b"".join([surface[i] for i in listed])
        if self.add_prefix or self.trim:
            head = next((i for i in listed if self.pieces[i][2] != CONTROL), None)
            if head is not None and self.pieces[head][2] == NORMAL and self.pieces[head][0].startswith(MARK):
                data = data[1:]
                if self.trim and not self.pieces[head][0].strip(MARK):
                    data = data.lstrip(b" ")
        return data.decode("utf-8", "each_byte")


def encode_pieces(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ids (binary: unsigned 32-bit little-endian), spans (binary: pairs of the same) and decoded text.

    ``model`` is the content of a model file, broadcast.  Null texts encode as empty ones:
    the begin and end id.  Texts are taken whole, one row per row; other columns are not read.
    An empty table gives no rows.
    """
    small_batches(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(quoted(id_col), quoted(text_col))
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                done = [pieces.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([i.tobytes() for i, _ in done], pa.binary()), pa.array([s.tobytes() for _, s in done], pa.binary()),
                     pa.array([pieces.decode(i) for i, _ in done], pa.string())], names=[id_col, "ids", "spans", "decoded"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, ids binary, spans binary, decoded string")


def loaded(data: bytes) -> PieceModel:
    """One model a worker, with what it remembers, for all its tasks."""
    return held_by_worker("pieces", hash(data), lambda: PieceModel(data))


def model_bytes(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@register("op5_pieces")
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_pieces(read_table(spark, sf_dir, "documents"), model_bytes())
    return encoded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), F.crc32("spans").alias("spans_crc32"))
