"""The stages alone and chained, and every query that has SQL against it."""

from collections import Counter

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from evenkeel.llm.queries import ORACLES, QUERIES
from evenkeel.llm.simhash import fingerprint, keep_one_per_component

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf, key):
    assert difference(QUERIES[key](spark, sf), connect(sf), ORACLES[key]) is None


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, "en", "src0", 0), (9002, "12345 !!", "en", "src0", 8), (9003, "", None, None, 0), (None, "A fine text of the corpus.", None, None, 9)],
        docs.schema,
    )
    docs, texts = docs.unionByName(odd), {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, before, sf).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == COLUMNS
        rows, times = after.collect(), Counter(r["doc_id"] for r in before.collect())
        assert all(r["text"] in texts[r["doc_id"]] for r in rows)
        if name != "mixing":
            assert all(n <= times[d] for d, n in Counter(r["doc_id"] for r in rows).items())
            assert 0.6 * before.count() < len(rows) < before.count()
        if name == "language_id":
            assert not {9001, 9002, 9003} & {r["doc_id"] for r in rows}
        if name == "simhash_near_dup":
            prints = [fingerprint(r["text"]) for r in rows]
            assert len(prints) == len(set(prints))
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert packed.agg(F.sum("length")).first()[0] == sum(len(r["text"].encode().split()) for r in before.collect())


def test_one_row_of_each_component_stays(spark):
    rows = [(5, "a b c d", 1), (2, "A b c D", 2), (2, "A b c D", 3), (2, "other words stand here now", 4), (7, "other words stand here now", 5),
            (None, "nobody knows this one", 6), (None, "nobody knows this one", 6), (8, "lone and apart", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    got = keep_one_per_component(df)
    assert got.columns == df.columns
    kept = sorted((str(r["doc_id"]), r["text"]) for r in got.collect())
    assert kept == [("2", "A b c D"), ("2", "other words stand here now"), ("8", "lone and apart"), ("None", "nobody knows this one")]
    assert keep_one_per_component(df.limit(0)).count() == 0


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.where("batch IS NOT NULL").count() > 0
    assert out.where("length > bucket OR padding < 0").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "simhash_near_dup", "mixing", "packing"]


def test_run_on_empty_tables(spark, sf, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
