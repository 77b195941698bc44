"""Bucket bounds against all ways to cut, and batches that hold every word once."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.llm.packing import PackRule, best_bounds, pack
from evenkeel.llm.queries import QUERIES


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(8))
def test_bounds_pad_the_least(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), 9))
    counts = [rng.randrange(1, 50) for _ in lengths]
    for k in (1, 2, 3, 9, 12):
        ours = best_bounds(np.array(lengths), np.array(counts), k)
        ways = (
            [*cut, lengths[-1]] for r in range(min(k, 9)) for cut in itertools.combinations(lengths[:-1], r)
        )
        assert len(ours) <= k and padding(lengths, counts, ours) == min(padding(lengths, counts, w) for w in ways)
    assert best_bounds(np.array([]), np.array([]), 3) == [] and best_bounds(np.array([7]), np.array([2]), 3) == [7]


def check_packed(rows, words, rule):
    held, batches = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r["doc_id"]].append((r["start"], r["length"]))
        if r["length"] == 0:
            assert r["bucket"] is r["batch"] is r["place"] is r["padding"] is None
        else:
            assert r["padding"] == r["bucket"] - r["length"] >= 0
            batches[r["bucket"], r["batch"]].append(r["place"])
    assert {d: sorted(h) for d, h in held.items()} == {
        d: sorted((s, min(n - s, rule.max_length)) for n in ns for s in range(0, max(n, 1), rule.max_length)) for d, ns in words.items()
    }
    last = defaultdict(int)
    for bucket, batch in batches:
        last[bucket] = max(last[bucket], batch)
    for (bucket, batch), places in batches.items():
        capacity = max(rule.token_budget // bucket, 1)
        assert sorted(places) == list(range(len(places))) and len(places) <= capacity
        assert len(places) == capacity or batch == last[bucket]
    assert len({b for b, _ in batches}) <= rule.buckets


def test_cases(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 90)) for i in range(500)] + [(7, "a b"), (7, "a b"), (None, "x y z"), (800, None)]
    rows += [(801, "long " * 2001)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("length", F.lit("clash"))
    words = defaultdict(list)
    for d, t in rows:
        words[d].append(len((t or "").split()))
    rule = PackRule(max_length=64, buckets=5, token_budget=256)
    packed = pack(df, rule)
    check_packed(packed.collect(), words, rule)
    assert sorted(map(str, packed.collect())) == sorted(map(str, pack(df.repartition(9), rule).collect()))
    assert pack(df.limit(0), rule).count() == 0


def test_query_packs_every_word_once(spark, sf):
    words = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words[r["doc_id"]].append(len(r["text"].replace("\xa0", "x").replace("\x85", "x").encode().split()))
    check_packed(QUERIES["op10_packing"](spark, sf).collect(), words, PackRule())
