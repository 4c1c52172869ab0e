"""URL allow / block lists as a broadcast trie.

The trie runs over the reversed labels of the host (``net``, ``example``, ...) and, below
a host that ends an entry, over the ``/``-separated segments of the path.  The deepest host
that has a fitting path wins; among its paths the longest wins; of two equal entries
``block`` wins.  A URL that no entry fits gets ``default``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import filter_rows, read_table, register

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

#: Most entries one broadcast trie may hold (about 200 bytes each); a longer list is an error.
MAX_ENTRIES = 1_000_000


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host follows the first ``://``; both empty without one."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return host.translate(_LOWER), tail[:end]


class UrlTrie:
    """Entries are ``(verdict, "host/path")``; an entry without ``/`` covers every path."""

    def __init__(self, entries: Iterable[tuple[str, str]]):
        self.root: dict = {"kids": {}, "paths": None}
        for n, (verdict, entry) in enumerate(entries, 1):
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            if n > MAX_ENTRIES:
                raise ValueError(f"more than {MAX_ENTRIES} entries")
            host, slash, path = entry.partition("/")
            self._add(host.translate(_LOWER), slash + path, entry, verdict)

    def _add(self, host: str, path: str, entry: str, verdict: str) -> None:
        node = self.root
        for label in reversed(host.split(".")):
            node = node["kids"].setdefault(label, {"kids": {}, "paths": None})
        if node["paths"] is None:
            node["paths"] = {"kids": {}, "ends": {}}
        at = node["paths"]
        *whole, begun = path.split("/")
        for segment in whole:
            at = at["kids"].setdefault(segment, {"kids": {}, "ends": {}})
        if at["ends"].get(begun, ("", ""))[1] != "block":
            at["ends"][begun] = (entry, verdict)

    @staticmethod
    def _longest(paths: dict, segments: list[str]) -> tuple[str, str] | None:
        found = None
        for segment in segments:
            ends = paths["ends"]
            fitting = [b for b in ends if segment.startswith(b)]
            if fitting:
                found = ends[max(fitting, key=len)]
            paths = paths["kids"].get(segment)
            if paths is None:
                break
        return found

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(entry, verdict) of the longest fitting entry, or None."""
        node, found, segments = self.root, None, path.split("/")
        for label in reversed(host.split(".")):
            node = node["kids"].get(label)
            if node is None:
                break
            if node["paths"] is not None:
                found = self._longest(node["paths"], segments) or found
        return found


def judge_urls(df: DataFrame, entries: Iterable[tuple[str, str]], id_col: str, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per row: ``id_col``, host, path, rule (fitting entry or null), verdict.

    One narrow pass, no shuffle; the entries are the caller's list (at most MAX_ENTRIES),
    broadcast once.  Null URLs and URLs without ``://`` have empty host and path and get
    ``default``.  Repeated rows are judged each; other columns are not read.
    """
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(entries))
    source = df.select(id_col, url_col)
    kind = source.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            hits = [match(h, p) for h, p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
                 pa.array([h and h[0] for h in hits], pa.string()), pa.array([h[1] if h else default for h in hits], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"])

    return source.mapInArrow(judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def keep_allowed(df: DataFrame, entries: Iterable[tuple[str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``df`` whose URL is allowed, all columns as they are."""
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(entries))

    def keep(urls: list) -> list[bool]:
        hits = [trie.value.match(*split_url(u)) for u in urls]
        return [(h[1] if h else default) == "allow" for h in hits]

    return filter_rows(df, url_col, keep)


ENTRIES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
named AS (
  SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM split),
entries(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
hits AS (
  SELECT n.page_id, n.host, n.path, e.h || e.p AS rule, e.verdict,
         row_number() OVER (PARTITION BY n.page_id ORDER BY length(e.h) - length(replace(e.h, '.', '')) DESC, length(e.p) DESC) AS k
  FROM named n LEFT JOIN entries e ON (n.host = e.h OR ends_with(n.host, '.' || e.h)) AND starts_with(n.path, e.p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hits WHERE k = 1
"""


@register("op6_url_filter", ORACLE)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), ENTRIES, "page_id")
