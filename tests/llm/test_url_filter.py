"""Longest matches against a plain search of all entries."""

import random

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.queries import URL_ENTRIES
from evenkeel.llm.url_filter import Entry, build_trie, host_and_path, judge_urls, longest_match


def plain(entries, host, path):
    fits = [e for e in entries if (host == e.host or host.endswith("." + e.host)) and path.startswith(e.path)]
    return max(fits, key=lambda e: (e.host.count("."), len(e.path)), default=None)


def test_trie_equals_plain_search():
    rng = random.Random(3)
    labels, parts = ["a", "b", "net", ""], ["", "x", "xy", "y"]
    path = lambda n: "".join("/" + rng.choice(parts) for _ in range(rng.randrange(n)))
    host = lambda: ".".join(rng.choice(labels[:3]) for _ in range(rng.randrange(1, 4)))
    entries = {(e.host, e.path): e for e in (Entry(host(), path(3), rng.choice(["allow", "block"])) for _ in range(60))}.values()
    root = build_trie(entries)
    for _ in range(3000):
        h, p = host(), path(5)
        assert longest_match(root, h, p) == plain(entries, h, p)


@pytest.mark.parametrize(
    "url, host, path",
    [
        (None, "", ""), ("no scheme/x", "", ""), ("", "", ""), ("http://", "", ""), ("HTTP://Ex.COM", "ex.com", ""),
        ("http://a.b/c/D?q=/x#y", "a.b", "/c/D"), ("http://a.b?x/y", "a.b", ""), ("x://a://b/c", "a:", "//b/c"), ("http://É.com/", "É.com", "/"),
    ],
)
def test_parts(url, host, path):
    assert host_and_path(url) == (host, path)


def test_pages(spark):
    urls = ["http://x.net", "http://x.net/", "http://example.net/en/1", "http://a.example.net/en", "http://badexample.net/en/1",
            "http://example.com/de/x", "http://example.org/fr/", "http://example.org/de/", None, "http://" + "a." * 50_000 + "net/q"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, urls[0])]
    df = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("html", F.lit("h"))
    out = judge_urls(df, URL_ENTRIES)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in out.collect()}
    assert [got[i] for i in range(len(urls))] == [
        (None, "allow"), ("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"), ("net/", "block"),
        ("example.com/de/", "block"), ("org/fr/", "allow"), (None, "allow"), (None, "allow"), ("net/", "block"),
    ]
    assert out.count() == len(rows) and out.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    assert judge_urls(df.limit(0), URL_ENTRIES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(df.withColumn("rule", F.lit(1)), URL_ENTRIES)


def test_bad_entries():
    with pytest.raises(ValueError, match="both"):
        build_trie([Entry("a", "/", "allow"), Entry("a", "/", "block")])
    with pytest.raises(ValueError, match="neither"):
        build_trie([Entry("a", "/", "maybe")])
