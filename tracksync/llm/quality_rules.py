"""Quality rules: a decision list learned from labelled text statistics.

``text_statistics`` measures every whole text.  ``learn`` covers the bad class one rule at
a time: a conjunction of thresholds is grown on two thirds of what is still uncovered by
information gain, cut back from its end on the other third, and kept while it is precise
enough there.  ``DecisionList.column`` is the ordered Spark conditional expression of the
list: the first rule that fits drops the document, no rule keeps it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, quoted, read_table, register

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_digits", "n_upper", "longest_word")
_NO_SPACE, _SYMBOLS, _DIGITS, _UPPER = b" \t\n\r\x0b\x0c", b"#*$%&|<>", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bound on the labelled rows the list is learned from (by hash order of doc_id).
MAX_LABELLED = 20_000


def repeated_words(words: list) -> int:
    """Words standing in a 3-word window that occurs twice or more, its first place included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict = {}
    inside = bytearray(len(words))
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            inside[i:i + 3] = b"\1\1\1"
            inside[j:j + 3] = b"\1\1\1"
    return sum(inside)


def measure(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text; a null text measures as an empty one."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    size = len(data)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    taken = lambda chars: size - len(data.translate(None, chars))
    return (len(words), len(text) - taken(_NO_SPACE), taken(_SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), len(set(words)), taken(_DIGITS), taken(_UPPER), max(map(len, words), default=0))


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the COUNTS (long) of every whole text; one narrow pass, one row per row."""
    source = df.select(quoted(id_col), quoted(text_col))
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [measure(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))], names=[id_col, *COUNTS])

    return source.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def _per(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


#: Statistics the rules test, as expressions over COUNTS.
def statistics() -> dict[str, Column]:
    return {
        "words": F.col("n_words").cast("double"), "mean_word": _per("word_chars", "n_words"), "symbol_share": _per("n_symbols", "word_chars"),
        "dup_line_share": _per("n_dup_lines", "n_lines"), "repeat_share": _per("n_repeat_words", "n_words"), "distinct_share": _per("n_distinct_words", "n_words"),
        "digit_share": _per("n_digits", "word_chars"), "upper_share": _per("n_upper", "word_chars"), "words_per_line": _per("n_words", "n_lines"),
        "longest_word": F.col("longest_word").cast("double"), "symbols": F.col("n_symbols").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    bound: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x > self.bound if self.above else x <= self.bound

    def column(self, exprs: dict[str, Column]) -> Column:
        return exprs[self.name] > F.lit(self.bound) if self.above else exprs[self.name] <= F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.bound:.6g}"


@dataclass
class DecisionList:
    rules: list[list[Condition]] = field(default_factory=list)

    def column(self, exprs: dict[str, Column]) -> Column:
        """Number (from 0) of the first rule that fits, else null."""
        out = None
        for i, rule in enumerate(self.rules):
            fits = rule[0].column(exprs)
            for c in rule[1:]:
                fits = fits & c.column(exprs)
            out = F.when(fits, F.lit(i)) if out is None else out.when(fits, F.lit(i))
        return F.lit(None).cast("int") if out is None else out.otherwise(F.lit(None).cast("int"))

    def describe(self) -> list[str]:
        return [" AND ".join(map(str, r)) for r in self.rules]


def _fits(rule: list[Condition], names: list[str], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x[:, names.index(c.name)])
    return out


def _best_condition(names: list[str], x: np.ndarray, bad: np.ndarray, cuts: int) -> Condition | None:
    """The condition of the highest information gain over the rows the rule covers so far."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    if not p0 or not n0:
        return None
    base, best, found = math.log2(p0 / (p0 + n0)), 1e-9, None
    for k, name in enumerate(names):
        values = np.unique(np.quantile(x[:, k], np.linspace(0, 1, cuts + 1), method="inverted_cdf"))[:-1]
        if not len(values):
            continue
        order = np.argsort(x[:, k], kind="stable")
        at = np.searchsorted(x[order, k], values, side="right")
        below_p = np.concatenate([[0], np.cumsum(bad[order])])[at]
        below_n = at - below_p
        for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), 0)
            i = int(np.argmax(gain))
            if gain[i] > best:
                best, found = gain[i], Condition(name, above, float(values[i]))
    return found


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], max_rules: int = 16, min_precision: float = 0.9, min_cover: int = 5, cuts: int = 64, seed: int = 5) -> DecisionList:
    """Sequential covering of the bad rows.  No bad or no good rows: the empty list."""
    out, rng = DecisionList(), np.random.default_rng(seed)
    left = np.ones(len(x), bool)
    while len(out.rules) < max_rules and (left & bad).sum() >= min_cover:
        rows = np.flatnonzero(left)
        held = rng.random(len(rows)) < 1 / 3
        grow, prune = rows[~held], rows[held]
        rule: list[Condition] = []
        while True:
            inside = grow[_fits(rule, names, x[grow])]
            c = _best_condition(names, x[inside], bad[inside], cuts)
            if c is None or len(rule) == 6:
                break
            rule.append(c)
        if not rule:
            break

        def worth(r: list[Condition], prune=prune) -> float:
            hit = _fits(r, names, x[prune])
            p, n = (hit & bad[prune]).sum(), (hit & ~bad[prune]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        hit = _fits(rule, names, x) & left
        if hit.sum() < min_cover or bad[hit].mean() < min_precision or (worth(rule) + 1) / 2 < min_precision:
            break
        out.rules.append(rule)
        left &= ~hit
    return out


def learn_from(statistics_of: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", bad_value: int = 0, max_rows: int = MAX_LABELLED, **how) -> DecisionList:
    """Learn from the labelled documents, at most ``max_rows`` of them in hash order of the id.

    Rows with a null label or id take no part; a document labelled twice counts twice, and so does a repeated
    row.  Empty tables, or labels that meet no document, give the empty list, which drops nothing.  Other columns
    of either table are not read.
    """
    exprs = statistics()
    labelled = statistics_of.join(labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col), (F.col(label_col) == bad_value).alias("_bad")), id_col)
    labelled = labelled.withColumn("_h", F.pmod(F.xxhash64(id_col), F.lit(1 << 40)))
    # twice the bound by hash first, so that no more than that is sent to the driver
    share = min(1.0, 2 * max_rows / max(1, labelled.count()))
    rows = labelled.filter(F.col("_h") < F.lit(int(share * (1 << 40)))).select("_h", "_bad", *[e.alias(f"_x_{n}") for n, e in exprs.items()]) \
        .orderBy("_h", "_bad", *[f"_x_{n}" for n in exprs]).limit(max_rows).collect()
    if not rows:
        return DecisionList()
    x = np.array([r[2:] for r in rows], float)
    return learn(x, np.array([r[1] for r in rows], bool), list(exprs), **how)


def judge(statistics_of: DataFrame, rules: DecisionList, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Statistics plus base_failed, rule (number of the rule that drops it, else null), kept.

    One row per row, repeated ones too; an empty table gives no rows.
    """
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    out = statistics_of.withColumn("base_failed", failed).withColumn("rule", rules.column(statistics()))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


@register("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialise(text_statistics(read_table(spark, sf_dir, "documents")), "quality-stats")
    rules = learn_from(measured, read_table(spark, sf_dir, "labels"))
    return judge(measured, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
