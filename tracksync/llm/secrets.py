"""Secret scan: fixed patterns, and sliding-window entropy per character class.

Everything is a Spark column expression over the whole text; there is one narrow pass and
no shuffle.

* Pattern kinds: leftmost non-overlapping matches of a regular expression; a match that fails
  its length test is dropped.
* Entropy kinds: for each character class the maximal runs of at least one window.  A fold
  over the run keeps the counts of the characters in the window and the sum of ``n log2 n``;
  one character enters, one leaves, and the Shannon entropy follows from that sum.  The span
  goes from the first to the last window at or over the class's threshold.
* Allow list, for entropy kinds only: a run that fits an entry of ``ALLOWED`` is left out.  A
  run with one of ``ALLOWED_WORDS`` is cut at the word, and the rest on either side is a run of
  its own: a key behind ``docs/example/`` is found as it would be alone.

Positions are code points, end exclusive.  Null texts are empty.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, read_table, register

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


@dataclass(frozen=True)
class Pattern:
    kind: str
    regex: str
    #: shortest second group, where the regex alone cannot say it
    least_group: int = 0


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    alphabet: str
    chars: str
    window: int
    least_bits: float

    @property
    def regex(self) -> str:
        return f"[{self.chars}]{{{self.window},}}"


# A run of n or more is the maximal run, so the length test of these kinds is in the regex.
PATTERNS = (Pattern("assign", _ASSIGN, 12), Pattern("access", r"AKIA[A-Z0-9]{14,}"), Pattern("hex", r"[0-9a-f]{16,}"))

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (
    EntropyClass("entropy_hex", _DIGITS + "abcdefABCDEF", "0-9a-fA-F", 24, 3.0),
    EntropyClass("entropy_upper", _UPPER + _DIGITS, "A-Z0-9", 18, 3.3),
    EntropyClass("entropy_base64", _UPPER + _LOWER + _DIGITS + "+/_=-", r"A-Za-z0-9+/_=\-", 24, 3.9),
)

#: Runs that look random and are none: words, numbers, identifiers, checksums.  Each fits a run from its start.
ALLOWED = (
    r"^[A-Za-z]?[a-z]+(?:[-_/][A-Za-z]?[a-z]+)*$", r"^[0-9]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^sha(?:1|256|384|512)-",
)
#: Counted-up alphabets and marks of samples, in either case; they belong to no window.
ALLOWED_WORDS = ("0123456789abcdef", "abcdefghijklmnop", "example", "sample", "dummy", "placeholder")
#: What joins a word to the rest of a run; the entries of ALLOWED do not see it at the ends of a rest.
_JOINTS = r"^[-_/+=]+|[-_/+=]+$"

_HITS = "array<struct<hit:string,start:int>>"
#: Hits are placed in blocks of this many, then block by block.
_BLOCK = 512


def _bound(value: Column, body) -> Column:
    """``body`` of a lambda variable that holds ``value``, so that value is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def located(text: Column, regex: str) -> Column:
    """All leftmost non-overlapping matches with their code-point starts.

    Matches and the gaps between them alternate, so running sums of lengths are the starts.
    """
    parts = F.zip_with(F.split(text, regex, -1), F.regexp_extract_all(text, F.lit(regex), F.lit(0)),
                       lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("size"), h.alias("hit")))
    none = F.array().cast(_HITS)
    begin = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def one(s, x):
        start = s["at"] + x["gap"]
        return F.struct((start + F.coalesce(x["size"], F.lit(0))).alias("at"),
                        F.concat(s["out"], F.array(F.struct(x["hit"].alias("hit"), start.alias("start")))).alias("out"))

    def block(s, b):
        moved = F.transform(b["out"], lambda o: F.struct(o["hit"].alias("hit"), (o["start"] + s["at"]).alias("start")))
        return F.struct((s["at"] + b["at"]).alias("at"), F.concat(s["out"], moved).alias("out"))

    def placed(p):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / _BLOCK).cast("int")),
                             lambda k: F.aggregate(F.slice(p, k * _BLOCK + 1, F.lit(_BLOCK)), begin, one))
        return F.filter(F.aggregate(blocks, begin, block)["out"], lambda o: o["hit"].isNotNull())

    return F.when(text.rlike(regex), _bound(parts, placed)).otherwise(none)


def window_span(run: Column, c: EntropyClass) -> Column:
    """struct(first, last): first hot window's start (-1: none) and last hot window's end, within the run."""
    w = c.window
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(w + 1)])
    most = w * (math.log2(w) - c.least_bits) + 1e-9  # entropy >= least_bits  <=>  sum of n log2 n <= most
    codes = F.transform(F.split(run, ""), lambda ch: F.position(ch, F.lit(c.alphabet)).cast("int"))
    moves = _bound(codes, lambda cs: F.zip_with(cs, F.concat(F.array_repeat(F.lit(0), w), F.slice(cs, F.lit(1), F.greatest(F.size(cs) - w, F.lit(0)))),
                                                lambda a, b: F.struct(a.alias("enters"), b.alias("leaves"))))
    start = F.struct(F.array_repeat(F.lit(0), len(c.alphabet)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("at"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(s, x):
        came, went = x["enters"], F.coalesce(x["leaves"], F.lit(0))
        n_in, n_out = F.get(s["counts"], came - 1), F.get(s["counts"], went - 1)
        less = F.when(went > 0, F.get(weight, n_out - 1) - F.get(weight, n_out)).otherwise(F.lit(0.0))
        total = F.when(came == went, s["total"]).otherwise(s["total"] + less + F.get(weight, n_in + 1) - F.get(weight, n_in))
        counts = F.when(came == went, s["counts"]).otherwise(
            F.transform(s["counts"], lambda n, k: n + (k == came - 1).cast("int") - (k == went - 1).cast("int")))
        hot = (s["at"] >= w - 1) & (total <= most)
        return F.struct(counts.alias("counts"), total.alias("total"), (s["at"] + 1).alias("at"),
                        F.when(hot & (s["first"] < 0), s["at"] - (w - 1)).otherwise(s["first"]).alias("first"),
                        F.when(hot, s["at"] + 1).otherwise(s["last"]).alias("last"))

    moves = F.filter(moves, lambda m: m["enters"] > 0)
    return F.aggregate(moves, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def pattern_spans(text: Column, p: Pattern, order: int) -> Column:
    hits = located(text, p.regex)
    if p.least_group:
        hits = F.filter(hits, lambda h: F.length(F.regexp_extract(h["hit"], p.regex, 2)) >= p.least_group)
    return F.transform(hits, lambda h: F.struct(h["start"].alias("start"), F.lit(order).alias("order"), (h["start"] + F.length(h["hit"])).alias("end"), F.lit(p.kind).alias("kind")))


def runs_between(text: Column, c: EntropyClass, allowed=ALLOWED, words=ALLOWED_WORDS) -> Column:
    """Runs of the class of at least one window, cut at allowed words, without those that fit the allow list."""
    runs = located(text, c.regex)
    fits = (lambda run: run.rlike("|".join(allowed))) if allowed else (lambda run: F.lit(False))
    runs = F.filter(runs, lambda h: ~fits(h["hit"]))
    if not words:
        return runs

    def cut(h):
        rest = h["hit"]
        for w in words:  # a word gives way to as many blanks, which no class holds
            rest = F.regexp_replace(rest, "(?i)" + re.escape(w), " " * len(w))
        rests = F.filter(located(rest, c.regex), lambda r: ~fits(F.regexp_replace(r["hit"], _JOINTS, "")))
        return F.transform(rests, lambda r: F.struct(r["hit"].alias("hit"), (h["start"] + r["start"]).alias("start")))

    has_word = "(?i)" + "|".join(re.escape(w) for w in words)
    return F.flatten(F.transform(runs, lambda h: F.when(h["hit"].rlike(has_word), cut(h)).otherwise(F.array(h))))


def entropy_spans(text: Column, c: EntropyClass, order: int, allowed=ALLOWED, words=ALLOWED_WORDS) -> Column:
    runs = runs_between(text, c, allowed, words)
    found = F.transform(runs, lambda h: F.struct(h["start"].alias("start"), window_span(h["hit"], c).alias("w")))
    return F.transform(F.filter(found, lambda f: f["w"]["first"] >= 0),
                       lambda f: F.struct((f["start"] + f["w"]["first"]).alias("start"), F.lit(order).alias("order"), (f["start"] + f["w"]["last"]).alias("end"), F.lit(c.kind).alias("kind")))


def secret_spans(text: Column, patterns=PATTERNS, classes=CLASSES, allowed=ALLOWED, words=ALLOWED_WORDS) -> Column:
    """Array of struct(start, order, end, kind), by start and then by kind in the order given."""
    text = F.coalesce(text, F.lit(""))
    parts = [pattern_spans(text, p, i) for i, p in enumerate(patterns)]
    parts += [entropy_spans(text, c, len(patterns) + i, allowed, words) for i, c in enumerate(classes)]
    return F.array_sort(F.concat(*parts))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``id_col`` and secrets: every span of every whole text, one row per row, repeated ones too.

    A null or empty text has no spans; an empty table gives no rows; other columns are not read.
    """
    return df.select(quoted(id_col), secret_spans(quoted(text_col), **how).alias("secrets"))


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """The text with every stretch that spans cover, overlaps joined, replaced by ``mark``."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def join(acc, s):
        last = F.element_at(acc, -1)
        own = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        wider = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= s["start"]), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), wider)).otherwise(F.concat(acc, own))

    def pieces(cover):
        begins = F.concat(F.array(F.lit(0)), F.transform(cover, lambda c: c["end"]))
        ends = F.concat(F.transform(cover, lambda c: c["start"]), F.array(F.length(text)))
        return F.array_join(F.zip_with(begins, ends, lambda b, e: F.substr(text, b + 1, e - b)), mark)

    return F.when(F.size(spans) > 0, _bound(F.aggregate(spans, none, join), pieces)).otherwise(text)


def redact_secrets(df: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", mark: str = "[SECRET]", **how) -> DataFrame:
    """Every row of ``df``, its columns as they are, secrets in the text replaced by ``mark``.

    ``chars_col``, where the frame has it, becomes the new text's length for changed texts.
    A null text stays null.
    """
    spans, text = "_secret_spans", "_secret_text"
    while spans in df.columns or text in df.columns:
        spans, text = spans + "_", text + "_"
    found = df.withColumn(spans, secret_spans(quoted(text_col), **how))
    found = found.withColumn(text, redacted(quoted(text_col), quoted(spans), mark))
    out = {text_col: quoted(text)}
    if chars_col is not None and chars_col in df.columns:
        kind = df.schema[chars_col].dataType
        out[chars_col] = F.when(F.size(quoted(spans)) > 0, F.length(quoted(text)).cast(kind)).otherwise(quoted(chars_col))
    return found.select(*[(out[c] if c in out else quoted(c)).alias(c) for c in df.columns])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("secrets", lambda s: s["order"] == i)).cast("long")
    base = F.filter("secrets", lambda s: s["order"] < len(PATTERNS))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))
