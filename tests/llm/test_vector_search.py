"""Recall and results against brute force, and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.llm.queries import QUERIES
from evenkeel.llm.vector_search import GraphRule, Shard, build_shard, nearest, search_shard, shard_plan

SMALL = GraphRule(least_shards=3)


def brute(ids, vectors, queries, k):
    out = {}
    for q in queries:
        score = vectors @ vectors[np.flatnonzero(ids == q)[0]]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def by_query(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [x[1:] for x in sorted(rows)] for q, rows in out.items()}


def shard_recall(x, rule, k=20, asks=150):
    band = int(np.floor(np.log2(np.linalg.norm(x, axis=1)).max() + 1e-9))
    shard = build_shard([np.array([i]) for i in range(len(x))], x, band, k, rule)
    row, found, score = search_shard(Shard.unpacked(shard.packed()), np.arange(asks), x[:asks], k)
    true = x[:asks] @ x.T
    true[np.arange(asks), np.arange(asks)] = -np.inf
    best = np.argsort(-true, axis=1)[:, :k]
    assert score == pytest.approx(true[row, found])
    return np.mean([len(set(found[row == i]) & set(best[i])) / k for i in range(asks)]), shard


def test_one_large_shard_keeps_its_recall():
    """5,000 vectors in one shard: the graph, not the number of shards, finds them. README has 20,000."""
    rng = np.random.default_rng(1)
    unit = lambda y: y / np.linalg.norm(y, axis=1, keepdims=True)
    clusters = rng.normal(size=(50, 24))[rng.integers(0, 50, 5000)] + 0.3 * rng.normal(size=(5000, 24))
    for x in (unit(rng.normal(size=(5000, 24))), unit(clusters)):
        recall, shard = shard_recall(x, GraphRule())
        assert recall >= 0.9 and shard.beam < 5000


def test_unequal_norms_in_one_band():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24)) * rng.uniform(0.2, 2, (3000, 1))
    assert shard_recall(x, GraphRule())[0] >= 0.9


@pytest.mark.parametrize("length", (1e3, 1e5, 1e200))
def test_one_long_vector_takes_nothing_from_the_others(spark, length):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 16))
    x[17] *= length
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = by_query(nearest(df, F.col("vec_id") % 20 == 0, 20, GraphRule(least_shards=2)))
    true = brute(np.arange(800), x, range(0, 800, 20), 20)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / 20 for q in true]) >= 0.9


def test_queries_in_several_blocks(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = by_query(nearest(df, F.col("vec_id") % 3 == 0, 5, GraphRule(least_shards=3, query_block=30)))
    assert {q: [i for i, _ in rows] for q, rows in got.items()} == {
        q: [i for i, _ in rows] for q, rows in brute(np.arange(300), x, range(0, 300, 3), 5).items()
    }


def test_shards_hold_no_more_than_their_bound():
    rule = GraphRule(least_shards=12, shard_rows=1000)
    plan = shard_plan([(64, 0, 100_000), (64, 9, 1), (2, 0, 500)], rule)
    assert plan == [(2, 0, 0, 1), (64, 0, 1, 100), (64, 9, 101, 1)]
    assert sum(s for *_, s in shard_plan([(64, 0, 50)], rule)) == 12


def test_few_and_odd_vectors(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)]  # many ties
    rows += [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (160, [1.0, float("nan"), 2.0]), (180, [float("inf"), 0.0, 1.0])]
    rows += [(200, [1.0, 2.0]), (201, [2.0, 2.0]), (None, [1.0, 1.0, 1.0]), (20, [6.0, 1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash"))
    got = by_query(nearest(df.where("vec_id != 20 OR vec_id IS NULL"), F.col("vec_id") % 20 == 0, 20, SMALL))
    kept = [(i, v) for i, v in rows if i is not None and i < 100 and i != 20]
    ids, vectors = np.array([i for i, _ in kept]), np.array([v for _, v in kept])
    assert got[0] == brute(ids, vectors, [0], 20)[0] and got[40] == brute(ids, vectors, [40], 20)[40]
    assert got[200] == [(201, 6.0)]
    assert set(got) == {0, 40, 200}
    assert set(by_query(nearest(df, F.col("vec_id") % 20 == 0, 20, SMALL))) == {0, 20, 40, 200}
    assert nearest(df.limit(0), F.lit(True)).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(500, 0, -1)] + [(1000 + i, [0.9, 0.1 * i]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = by_query(nearest(df, F.col("vec_id") == 20, 20, SMALL))[20]
    kept = np.array([v for _, v in rows], np.float32).astype(float)
    assert [i for i, _ in got] == [i for i, _ in brute(np.array([i for i, _ in rows]), kept, [20], 20)[20]]


def test_query_recall(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], float)
    got = by_query(QUERIES["op7_vector_search"](spark, folder))
    true = brute(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(true)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / len(true[q]) for q in true]) > 0.95
    for q, found in got.items():
        assert len(found) == len(true[q])
        assert [s for _, s in found] == pytest.approx([float(vectors[ids == i][0] @ vectors[ids == q][0]) for i, _ in found])
