"""Targets, permutations and the mix against plain versions."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.mixing import MixRule, mix_sources, permuted, repeat_documents, rounds, source_targets
from evenkeel.llm.ordering import shuffled, sum_before
from evenkeel.llm.queries import QUERIES


def plain_targets(sizes):
    """Share by weight; cap what is above its limit, share the rest again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole > 3 * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / whole for s in open_}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_plain_version(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 7, 100, 5000, 100_000]) for s in [None, "", "a", "b", "ß", "Z", "é", "10", "9", "zz", "😀"]}
    rows = [(s, "=" + s if s is not None else "", n) for s, n in sizes.items()]
    df = spark.createDataFrame(rows, "source string, _key string, size bigint")
    got = {r["_key"]: r["target"] for r in source_targets(df, MixRule()).collect()}
    for s, t in plain_targets(sizes).items():
        assert got["=" + s if s is not None else ""] == pytest.approx(t)


@pytest.mark.parametrize("size", [1, 2, 3, 64, 65, 1000])
def test_permutation_is_a_bijection(spark, size):
    slots = spark.range(size).select(
        F.col("id").alias("index"), F.lit(size).cast("long").alias("blocks"), F.lit("=a").alias("_key"), F.lit(0).alias("pass")
    )
    got = [r["block"] for r in permuted(slots.withColumn("rounds", rounds(MixRule()))).orderBy("index").collect()]
    assert sorted(got) == list(range(size))
    assert size < 64 or got != list(range(size))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(1, 400)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "d"), (5, "again " * 50, "b"), (5, "again " * 50, "b"), (None, "no id here", "c")]
    rows += [(902, "long " * 30_000, "c")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("clash"))


def test_mix_takes_near_its_targets(spark, corpus):
    rule = MixRule(block_words=16, shard_slots=500)
    mix = mix_sources(corpus, rule)
    rows = mix.taken().collect()
    assert len(rows) == corpus.count()
    sums, targets, sizes = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sums[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        targets[r["source"]] = r["target"]
    assert targets == pytest.approx(plain_targets(dict(sizes)))
    for s, t in targets.items():
        assert abs(sums[s] - t) <= max(0.02 * t, 16 * 5)
    # The blocks are the mix that the counts speak of, and each is whole.
    blocks = mix.blocks().collect()
    assert sum(b["to"] - b["from"] for b in blocks) == sum(sums.values())
    per_slot, places = Counter(), defaultdict(set)
    for b in blocks:
        per_slot[b["shard"], b["place"]] += b["to"] - b["from"]
        places[b["shard"]].add(b["place"])
    assert max(per_slot.values()) == 16
    assert all(max(p) < 500 for p in places.values())
    assert sorted(map(str, rows)) == sorted(map(str, mix_sources(corpus.repartition(7), rule).taken().collect()))


def test_taken_equals_plain_count_of_the_slots(spark, corpus):
    """What a document gives is counted again from the mix's slots and the documents' places, word by word."""
    rule = MixRule(block_words=16, shard_slots=500)
    mix = mix_sources(corpus, rule)
    times = Counter((r["_key"], r["block"]) for r in mix.slots.collect())
    placed = mix.placed.collect()
    by_source = defaultdict(list)
    for r in placed:
        by_source[r["_key"]].append(r)
    want = []
    for key, rows in by_source.items():
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at  # the stream has no gaps
            want.append((str(r["doc_id"]), r["size"], sum(times[key, w // 16] for w in range(at, at + r["size"]))))
            at += r["size"]
    got = [(str(r["doc_id"]), r["size"], r["taken"]) for r in mix.taken().where("size > 0").collect()]
    assert sorted(got) == sorted(want)
    # Slots of a source: no block oftener than the passes, and in each pass but the last every block once.
    sizes = {r["_key"]: r["source_size"] for r in mix.targets.collect()}
    passes = Counter((r["_key"], r["pass"], r["block"]) for r in mix.slots.collect())
    assert set(passes.values()) == {1} and all(p < 3 and b < -(-sizes[k] // 16) for k, p, b in passes)


def test_shards_spread_as_multinomial_draws(spark):
    """Counts of a source over shards vary as in draws with its share; a systematic deal would vary by a quarter at most."""
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 4000), ("b", 2000), ("c", 1500)] * 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    slots = mix_sources(df, MixRule(block_words=1, shard_slots=100)).slots
    table = defaultdict(Counter)
    for r in slots.groupBy("_key", "shard").count().collect():
        table[r["_key"]][r["shard"]] = r["count"]
    shards = max(max(c) for c in table.values())  # the last one may be short
    assert shards >= 500
    for counts in table.values():
        own = [counts[k] for k in range(shards)]
        mean = sum(own) / shards
        variance = sum((x - mean) ** 2 for x in own) / shards
        share = mean / 100
        assert variance == pytest.approx(100 * share * (1 - share), rel=0.25)
    whole = [sum(c[k] for c in table.values()) for k in range(shards)]
    assert set(whole) == {100}


def test_sums_in_three_levels(spark, monkeypatch):
    monkeypatch.setattr("evenkeel.llm.ordering.CHUNK_ROWS", 2)
    df = spark.range(3000).select(F.lit("g").alias("g"), "id", (F.col("id") % 7 + 1).alias("v"))
    ordered = shuffled(df, [F.col("id")], 3000)
    order = [r["id"] for r in ordered.orderBy("_order").collect()]
    got = {r["id"]: r["_before"] for r in sum_before(ordered, "g", "v", ["id"]).collect()}
    at = 0
    for i in order:
        assert got[i] == at
        at += i % 7 + 1


def test_too_many_sources_are_refused(spark, corpus, monkeypatch):
    monkeypatch.setattr("evenkeel.llm.mixing.MAX_SOURCES", 2)
    with pytest.raises(ValueError):
        mix_sources(corpus)


def test_other_names(spark, corpus):
    renamed = corpus.withColumnsRenamed({"doc_id": "id", "text": "_words", "source": "_share"})
    assert repeat_documents(renamed, doc_id="id", text="_words", source="_share").columns == renamed.columns


def test_whole_documents(spark, corpus):
    out = repeat_documents(corpus)
    assert out.columns == corpus.columns
    texts = {(r["doc_id"], r["text"]) for r in corpus.collect()}
    rows = out.collect()
    assert rows and all((r["doc_id"], r["text"]) in texts for r in rows)
    assert max(Counter(r["doc_id"] for r in rows if r["doc_id"] != 5).values()) <= 3
    assert repeat_documents(corpus.limit(0)).count() == 0


def test_empty(spark, corpus):
    assert mix_sources(corpus.limit(0)).taken().count() == 0
    assert mix_sources(corpus.where("doc_id IN (900, 901)")).taken().agg(F.sum("taken")).first()[0] == 0


def test_query_is_near_its_targets(spark, sf):
    rows = QUERIES["op2_mixing"](spark, sf)
    by = rows.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target"), F.sum("size").alias("n"))
    for r in by.collect():
        assert r["t"] == pytest.approx(r["target"], rel=0.1) and r["t"] <= 3 * r["n"]
