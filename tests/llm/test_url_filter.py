from __future__ import annotations

import random

import pytest

from tracksync.llm.url_filter import UrlTrie, judge_urls, keep_allowed, split_url

ENTRIES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "b.org/fr/x"), ("allow", "c")]


def brute(url, entries, default="allow"):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.split(mark)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, entry in entries:
        h, slash, p = entry.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            rank = (h.count("."), len(h), len(slash + p), verdict == "block")
            best = max(best, (rank, entry, verdict)) if best else (rank, entry, verdict)
    return host, path, best[1] if best else None, best[2] if best else default


def test_fixed_cases():
    trie = UrlTrie(ENTRIES)
    assert trie.match("a.net", "") is None
    assert trie.match("a.net", "/") == ("net/", "block")
    assert trie.match("w.example.net", "/en/1") == ("example.net/en/", "allow")
    assert trie.match("example.net", "/english") == ("net/", "block")
    assert trie.match("notexample.com", "/de/") is None
    assert split_url("http://A.b?x=://y/z") == ("a.b", "")
    assert split_url(None) == split_url("no scheme/x") == ("", "")


@pytest.mark.parametrize("seed", [1, 2])
def test_random_urls_like_brute_force(spark, seed):
    rnd = random.Random(seed)
    host = lambda: ".".join(rnd.choice(["net", "org", "example", "com", "b", "C", "", "É"]) for _ in range(rnd.randint(1, 4)))
    path = lambda: "".join(rnd.choice(["/", "/", "en", "fr", "de", "x", "?", "#"]) for _ in range(rnd.randint(0, 6)))
    urls = [rnd.choice(["http://", "://", "", "a"]) + host() + path() for _ in range(500)] + [None, "", "://", "http:///en/", "x" * 100_000]
    entries = ENTRIES + [("block", host().lower() + "/" + path().replace("?", "").replace("#", "")) for _ in range(20)]
    entries = list(dict(((e, v) for v, e in entries)).items())
    entries = [(v, e) for e, v in entries]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, entries, "page_id").collect()}
    assert got == {i: brute(u, entries) for i, u in enumerate(urls)}
    kept = keep_allowed(df, entries)
    assert kept.columns == df.columns
    assert {r["page_id"] for r in kept.collect()} == {i for i, r in got.items() if r[3] == "allow"}


def test_repeats_empty_table_and_bad_entries(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    assert judge_urls(df, ENTRIES, "page_id").count() == 3
    assert judge_urls(df.filter("false"), ENTRIES, "page_id").count() == 0
    with pytest.raises(ValueError):
        UrlTrie([("maybe", "net/")])
