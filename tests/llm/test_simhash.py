"""Fingerprints and components against plain loops."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from evenkeel.llm import simhash
from evenkeel.llm.queries import QUERIES
from evenkeel.llm.simhash import fingerprint, linked, near_duplicates, near_links, ring_keys, smallest_reachable


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    parent = {f: f for f in fps}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    order = sorted(fps)
    for i, x in enumerate(order):
        for y in order[:i]:
            if (x ^ y).bit_count() <= 3:
                parent[max(top(x), top(y))] = min(top(x), top(y))
    return {f: top(f) for f in fps}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def planted(n=400, seed=5):
    """Random fingerprints, chains of near ones, and one dense ball."""
    rng = random.Random(seed)
    out = set()
    for _ in range(n):
        f = rng.getrandbits(64)
        out.add(f)
        for _ in range(rng.randrange(4)):
            for _ in range(rng.randrange(1, 5)):
                f ^= 1 << rng.randrange(64)
            out.add(f)
    center = rng.getrandbits(64)
    for _ in range(300):
        f = center
        for _ in range(rng.randrange(4)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return sorted(out)


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two", "A b C", "a b c d\x0be\x0c\r f", "é É ß " * 40, "x " * 70000])
def test_fingerprint(text):
    assert int.from_bytes(fingerprint(text), "big") == plain_fingerprint(text)


def test_every_near_pair_shares_a_key_and_passes_its_chain(spark):
    rng, pairs = random.Random(1), []
    for _ in range(3000):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), rng.randrange(4)):
            y ^= 1 << bit
        pairs.append((signed(x), signed(y)))
    keyed = spark.createDataFrame(pairs, "x bigint, y bigint").select("x", "y", F.arrays_overlap(ring_keys("x"), ring_keys("y")))
    assert all(r[2] for r in keyed.collect())
    x, y = (np.array(c, np.int64).view(np.uint64) for c in zip(*pairs))
    assert np.any([linked(x, y, np.full(x.size, s)) for s in range(8)], axis=0).all()


@pytest.mark.parametrize("block", [4096, 32])
def test_components_equal_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    fps = planted()
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint").repartition(5)
    got = {r["node"]: r["root"] for r in smallest_reachable(near_links(df)).collect()}
    groups, wanted = {}, plain_components(fps)
    for f in fps:
        groups.setdefault(wanted[f], set()).add(signed(f))
    ours = {}
    for f in fps:
        ours.setdefault(got.get(signed(f), signed(f)), set()).add(signed(f))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint")
    assert {r["root"] for r in smallest_reachable(edges).collect()} == {0}


def test_cases(spark):
    rows = [(5, None), (3, ""), (9, "a b c d"), (9, "a b c d"), (2, "A B  c\nd"), (None, "lone words here"), (7, "q r s t u")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("component", F.lit("other"))
    got = {(r["doc_id"], r["component_id"]) for r in near_duplicates(df).collect()}
    assert got == {(5, 3), (3, 3), (9, 2), (2, 2), (None, None), (7, 7)}
    assert near_duplicates(df).count() == 7
    assert near_duplicates(df.limit(0)).count() == 0


def test_query_equals_plain_version(spark, sf):
    rows = {r["doc_id"]: r for r in QUERIES["op8_simhash_near_dup"](spark, sf).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    tops = plain_components(set(fps.values()))
    least = {}
    for d, f in fps.items():
        least[tops[f]] = min(d, least.get(tops[f], d))
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in rows.items()} == {
        d: (f"{f:016x}", least[tops[f]]) for d, f in fps.items()
    }
