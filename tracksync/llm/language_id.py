"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read as its runs of letters, lower-cased; a run is one byte sequence framed by
blanks (runs over ``LONGEST`` bytes are read in pieces).  The network labels every byte of
every run with a probability for each language, and a document's probabilities are the mean
over all its labelled bytes.  Training is plain numpy: back-propagation through time in both
directions, Adam, cross-entropy at every position, on a bounded sample of labelled documents.

A run's labels depend on the run alone, so each worker labels a run once and remembers the
sum of its labels, up to ``REMEMBERED`` runs.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import filter_rows, held_by_worker, materialise, quoted, read_table, register, small_batches

RUN = re.compile(r"[^\W\d_]+")  # letters, and the few numbers that are no decimal digits: see letters()
LONGEST = 64
REMEMBERED = 250_000
UNDECIDED = "und"

#: Bound of the training sample: documents of each language, each read whole.
DOCS_PER_LANGUAGE = 64
#: Most languages a network may tell apart: their counts are broadcast.
MAX_LANGUAGES = 10_000


def letters(run: str) -> list[str]:
    """The runs of letters in a run of letters and numbers such as \u00bd, \u00b2, \u2167."""
    return [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()


def sequences(run: str) -> list[bytes]:
    data = run.encode()
    return [data[i:i + LONGEST] for i in range(0, len(data), LONGEST)]


class ByteGRU:
    """Parameters and passes.  Arrays are (time, batch, ...); direction 1 reads time backwards."""

    def __init__(self, classes: int, hidden: int = 16, seed: int = 1):
        rng, h = np.random.default_rng(seed), hidden
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.hidden, self.classes = h, classes
        self.p = {}
        for d in "fb":
            self.p["E" + d] = draw(256, 3 * h, scale=0.3)       # input weights of each byte: update, reset, candidate
            self.p["U" + d] = draw(h, 3 * h, scale=h ** -0.5)   # recurrent weights
            self.p["c" + d] = np.zeros(3 * h, np.float32)
        self.p["O"] = draw(2 * h, classes, scale=h ** -0.5)
        self.p["o"] = np.zeros(classes, np.float32)

    @staticmethod
    def _gate(x: np.ndarray) -> np.ndarray:
        return 0.5 * np.tanh(0.5 * x) + 0.5

    def _states(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        steps, batch = x.shape
        h, e, u = self.hidden, self.p["E" + d] + self.p["c" + d], self.p["U" + d]
        state = np.zeros((batch, h), e.dtype)
        out, kept = np.empty((steps, batch, h), e.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a, g = e[x[t]], state @ u
            zr = self._gate(a[:, :2 * h] + g[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(a[:, 2 * h:] + r * g[:, 2 * h:])
            new = n + z * (state - n)
            if keep:
                kept.append((t, state, z, r, n, g[:, 2 * h:]))
            state = out[t] = new
        return out, kept

    def forward(self, x: np.ndarray, keep: bool = False):
        """Label probabilities (time, batch, classes) of byte sequences x (time, batch)."""
        f, kf = self._states(x, "f", keep)
        b, kb = self._states(x, "b", keep)
        both = np.concatenate([f, b], axis=2)
        y = both @ self.p["O"] + self.p["o"]
        y -= y.max(axis=2, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=2, keepdims=True)
        return (y, both, kf, kb) if keep else y

    def gradients(self, x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over the positions of weight 1, and its gradient by back-propagation through time."""
        y, both, kf, kb = self.forward(x, keep=True)
        total, h = weight.sum(), self.hidden
        steps, batch, _ = y.shape
        at = np.arange(batch)
        loss = float(-(np.log(y[:, at, label] + 1e-12) * weight).sum() / total)
        dy = y.copy()
        dy[:, at, label] -= 1
        dy *= (weight / total)[:, :, None].astype(dy.dtype)
        grads = {"O": both.reshape(-1, 2 * h).T @ dy.reshape(-1, self.classes), "o": dy.sum(axis=(0, 1))}
        dboth = dy @ self.p["O"].T
        for d, kept, own in (("f", kf, dboth[:, :, :h]), ("b", kb, dboth[:, :, h:])):
            u = self.p["U" + d]
            du, de, dc = np.zeros_like(u), np.zeros_like(self.p["E" + d]), np.zeros_like(self.p["c" + d])
            carry = np.zeros((batch, h), u.dtype)
            for t, before, z, r, n, gn in reversed(kept):
                ds = own[t] + carry
                dn = ds * (1 - z) * (1 - n * n)
                da = np.concatenate([ds * (before - n) * z * (1 - z), dn * gn * r * (1 - r), dn], axis=1)
                dg = da.copy()
                dg[:, 2 * h:] *= r
                du += before.T @ dg
                np.add.at(de, x[t], da)
                dc += da.sum(axis=0)
                carry = ds * z + dg @ u.T
            grads |= {"U" + d: du, "E" + d: de, "c" + d: dc}
        return loss, grads

    def fit(self, runs: list[bytes], labels: np.ndarray, epochs: int = 3, batch: int = 256, rate: float = 0.01, seed: int = 2) -> list[float]:
        """Adam over batches of runs of one length; returns the mean loss of each epoch."""
        rng, losses = np.random.default_rng(seed), []
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * len(batches_of(runs, range(len(runs)), batch))
        for _ in range(epochs):
            parts = batches_of(runs, rng.permutation(len(runs)), batch)
            sums = []
            for k in rng.permutation(len(parts)):
                x, weight = framed([runs[i] for i in parts[k]])
                loss, grads = self.gradients(x, labels[parts[k]], weight)
                step += 1
                now = rate * (1 - 0.9 * step / total)
                for name, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    self.p[name] -= (now * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
                sums.append(loss)
            losses.append(float(np.mean(sums)))
        return losses

    def label_sums(self, runs: list[bytes], batch: int = 512) -> np.ndarray:
        """For each sequence the sum of its bytes' label probabilities."""
        out = np.zeros((len(runs), self.classes), np.float64)
        for some in batches_of(runs, range(len(runs)), batch):
            x, weight = framed([runs[i] for i in some])
            y = self.forward(x)
            out[some] = (y * weight[:, :, None]).sum(axis=0)
        return out


def batches_of(runs: list[bytes], order, size: int) -> list[list[int]]:
    """Places of the runs in batches of one length each: no padding, so labels do not depend on the company."""
    by_length: dict[int, list[int]] = {}
    for i in order:
        by_length.setdefault(len(runs[i]), []).append(i)
    return [own[k:k + size] for own in by_length.values() for k in range(0, len(own), size)]


def framed(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(time, batch) bytes with a blank before and blanks after each run, and weight 1 on the run's bytes."""
    longest = max(map(len, runs))
    x = np.full((len(runs), longest + 2), 32, np.int64)
    weight = np.zeros((len(runs), longest + 2), np.float32)
    for i, r in enumerate(runs):
        x[i, 1:1 + len(r)] = np.frombuffer(r, np.uint8)
        weight[i, 1:1 + len(r)] = 1
    return x.T.copy(), weight.T.copy()


class Identifier:
    """A trained network, its languages, and the labels of the runs it has met."""

    def __init__(self, network: ByteGRU, languages: list[str]):
        self.network, self.languages = network, languages
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sums = np.zeros((1024, len(self.languages) + 1))

    def __getstate__(self):
        return {"network": self.network, "languages": self.languages}

    def __setstate__(self, state):
        self.__init__(state["network"], state["languages"])

    def _learn_runs(self, new: list[str]) -> None:
        parts, owner = [], []
        for i, run in enumerate(new):
            for s in (s for own in letters(run) for s in sequences(own)):
                parts.append(s)
                owner.append(i)
        made = np.zeros((len(new), len(self.languages) + 1))
        if parts:
            np.add.at(made[:, :-1], owner, self.network.label_sums(parts))
            np.add.at(made[:, -1], owner, [len(s) for s in parts])
        begin = len(self.known)
        while len(self.sums) < begin + len(new):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        self.sums[begin:begin + len(new)] = made
        self.known.update(zip(new, range(begin, begin + len(new)), strict=True))

    def probabilities(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Pooled probabilities of each text; None for a text without a letter."""
        if not self.languages:
            return [None] * len(texts)
        if len(self.known) > REMEMBERED:
            self.forget()
        runs = [RUN.findall(t.lower()) if t else [] for t in texts]
        new = list({r for rs in runs for r in rs}.difference(self.known))
        if new:
            self._learn_runs(sorted(new))
        out = []
        for rs in runs:
            total = self.sums[np.fromiter(map(self.known.__getitem__, rs), np.int64, len(rs))].sum(axis=0) if rs else [0]
            out.append(total[:-1] / total[-1] if total[-1] > 0 else None)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Most probable language (ties: the first by name) and its pooled probability; ``und``, 0.0 without a letter."""
        langs, scores = [], []
        for p in self.probabilities(texts):
            best = -1 if p is None else int(np.argmax(p))
            langs.append(UNDECIDED if p is None else self.languages[best])
            scores.append(0.0 if p is None else float(min(1.0, max(0.0, p[best]))))
        return langs, scores


def held_out(id_col: str = "doc_id") -> Column:
    """True for the documents that take no part in training."""
    return F.coalesce(F.crc32(quoted(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, hidden: int = 16, epochs: int = 3) -> bytes:
    """Fit on at most ``docs_per_language`` labelled documents of each language, on all their letters.

    Only documents with text, lang and doc_id that are not held out; the lowest hashes of
    doc_id are taken.  The sample is bounded, so the fit runs in one task; returns the pickled
    Identifier.  No labelled rows, as of an empty table: an identifier that decides nothing.
    Repeated rows are drawn like others, rows of one id all or none (ties: the first texts).
    """
    small_batches(docs.sparkSession)
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .select("lang", "text", F.xxhash64("doc_id").alias("_h"))
    # twice the bound by hash first, which any partition can tell, then the lowest hashes of those
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    drawn_share = F.pmod(F.col("_h"), F.lit(1 << 30)) < F.lit(float(2 * docs_per_language * (1 << 30))) / F.col("_n")
    counts = materialise(counts, "language-counts")
    if counts.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    near = usable.join(F.broadcast(counts), "lang").filter(drawn_share)
    lowest = W.partitionBy("lang").orderBy(F.pmod("_h", F.lit(1 << 30)), "_h", "text")
    sample = near.withColumn("_k", F.row_number().over(lowest)).filter(F.col("_k") <= docs_per_language).select("lang", "text", "_h")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, kept = [], []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True):
                langs.append(lang)
                kept.append(" ".join(own for run in RUN.findall(text.lower()) for own in letters(run)))
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "runs": pa.array(kept, pa.string()), "h": batch.column(2)})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((h, lang, runs) for b in batches for lang, runs, h in zip(*(c.to_pylist() for c in b.columns), strict=True))
        languages = sorted({lang for _, lang, _ in rows})
        found = [(s, languages.index(lang)) for _, lang, runs in rows for run in runs.split() for s in sequences(run)]
        network = ByteGRU(len(languages), hidden)
        if found:
            network.fit([s for s, _ in found], np.array([k for _, k in found]), epochs)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(Identifier(network, languages if found else []))]})

    drawn = sample.mapInArrow(draw, "lang string, runs string, h long")
    return bytes(drawn.repartition(1).mapInArrow(fit, "model binary").first()["model"])


def loaded(model: bytes) -> Identifier:
    """One identifier a worker, with what it remembers, for all its tasks."""
    return held_by_worker("language", hash(model), lambda: pickle.loads(model))


def identify(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score of every whole text; the prediction reads the text alone.

    Null texts and texts without a letter give ``und`` and 0.0.  One row per row, repeated ones too; an
    empty table gives none.
    """
    small_batches(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(quoted(id_col), quoted(text_col))
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = loaded(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                langs, scores = identifier.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def keep_identified(df: DataFrame, model: bytes, least_score: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose language is decided with at least ``least_score``, all columns as they are."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def keep(texts: list) -> list[bool]:
        langs, scores = loaded(held.value).predict(texts)
        return [k != UNDECIDED and s >= least_score for k, s in zip(langs, scores, strict=True)]

    return filter_rows(df, text_col, keep)


@register("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs)
    found = identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
