"""PPM scores against a plain recursive version, and word scores against a counter."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.ppm import END, PAD, SYMBOLS, score_texts, scored_ngrams
from evenkeel.llm.queries import QUERIES

TEXTS = [
    (1, "the cat sat on the mat", True),
    (2, "The dog sat.\n\tOn the log", True),
    (3, "the cat sat on the mat", True),
    (4, "", True),
    (5, None, True),
    (6, "ünïcödé wörds ünïcödé", True),
    (7, "the zebra quit", False),
    (8, None, False),
    (9, "x" * 3000, False),
    (None, "cat mat", None),
    (7, "the zebra quit", False),
]


def lowered(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def plain_score(text, training, order):
    """log10 probability by walking the contexts with exclusion, symbol by symbol."""
    follows = defaultdict(Counter)
    for t in training:
        s = [PAD] * order + list(lowered(t)) + [END]
        for i in range(order, len(s)):
            for m in range(order + 1):
                follows[tuple(s[i - m : i])][s[i]] += 1
    s, total = [PAD] * order + list(lowered(text)) + [END], 0.0
    for i in range(order, len(s)):
        excluded, p = set(), 1.0
        for m in range(order, -1, -1):
            seen = follows.get(tuple(s[i - m : i]))
            if not seen:
                continue
            left = {k: v for k, v in seen.items() if k not in excluded}
            whole = sum(left.values()) + len(left)
            if s[i] in left:
                p *= left[s[i]] / whole
                break
            if left:
                p *= len(left) / whole
            excluded = set(seen)
        else:
            p /= SYMBOLS - len(excluded)
        total += math.log10(p)
    return total


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(TEXTS, "doc_id bigint, text string, train boolean").withColumn("extra", F.lit("x"))
    return score_texts(df.repartition(3), F.col("train"), order=3).collect()


def test_scores_equal_plain_version(rows):
    training = [t for _, t, train in TEXTS if train]
    words = Counter(w for t in training for w in lowered(t).split())
    ends, kinds = len(training), len(words) + 1
    total = sum(words.values()) + ends
    assert len(rows) == len(TEXTS)
    by_text = {t: plain_score(t, training, 3) for _, t, _ in TEXTS}
    texts = defaultdict(list)
    for d, t, _ in TEXTS:
        texts[d].append(t)
    for r in rows:
        text = texts[r["doc_id"]][0]
        tokens = lowered(text).split()
        base = sum(math.log10((words[w] + 1) / (total + kinds)) for w in tokens) + math.log10((ends + 1) / (total + kinds))
        base += (len(tokens) + 1) * (math.log10(total + kinds) - math.log10(total + kinds + 1))
        assert r["n_tokens"] == len(tokens) + 1
        assert r["n_known"] == sum(w in words for w in tokens) + 1
        assert r["train_tokens"] == total
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(by_text[text], rel=1e-9)
        assert r["extra"] == "x"


@pytest.mark.parametrize("order", (1, 3, 7))
def test_rare_ngrams_are_scored_from_their_counts(spark, order):
    """A capacity far below the number of n-grams changes no score."""
    more = TEXTS + [(10, "the quick brown fox, überall überall", True), (11, "a quick überfox sat on the zebra", False)]
    training = [t for _, t, train in more if train]
    df = spark.createDataFrame(more, "doc_id bigint, text string, train boolean")
    got = score_texts(df.repartition(3), F.col("train"), order=order, capacity=2).collect()
    texts = {d: t for d, t, _ in more}
    assert len(got) == len(more)
    for r in got:
        assert r["score"] == pytest.approx(plain_score(texts[r["doc_id"]], training, order), rel=1e-9)


def test_probabilities_sum_to_one(spark):
    """Behind any context, known or not, the symbols share a probability of one."""
    training = ["abracadabra", "abba", "cab"]
    counts = Counter()
    for t in training:
        s = [PAD] * 2 + list(t.encode()) + [END]
        counts.update(int.from_bytes(bytes(s[i - 2 : i + 1]), "big") for i in range(2, len(s)))
    contexts = (b"ab", b"ra", b"\xff\xff", b"zz", b"za")
    assert SYMBOLS <= 257  # bytes that UTF-8 has no use for stand for the end and the padding
    for context in contexts:
        for symbol in range(256):
            counts.setdefault(int.from_bytes(context + bytes([symbol]), "big"), 0)
    ngrams = spark.createDataFrame([(k, n, 1) for k, n in counts.items()], "key bigint, n bigint, used bigint")
    fresh = {r["key"]: r["fresh"] for r in scored_ngrams(ngrams, 2).collect()}
    for context in contexts:
        own = [10.0 ** fresh[int.from_bytes(context + bytes([s]), "big")] for s in range(256)]
        # The alphabet may have one symbol more than there are bytes; it is never seen and scores as any unseen one.
        assert sum(own) + (SYMBOLS - 256) * min(own) == pytest.approx(1.0)


def test_no_training_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in score_texts(df, F.lit(False)).collect()}
    assert got[1]["score"] == pytest.approx(-3 * math.log10(SYMBOLS))
    assert got[2]["score"] == pytest.approx(-math.log10(SYMBOLS))
    assert (got[1]["n_known"], got[1]["train_tokens"], got[1]["base_score"]) == (0, 0, 0.0)
    assert score_texts(df.limit(0), F.lit(True)).count() == 0


def test_clashing_name(spark):
    with pytest.raises(ValueError):
        score_texts(spark.createDataFrame([("a", 1)], "text string, score int"), F.lit(True))


def test_query_beats_words_on_held_out_texts(spark, sf):
    got = QUERIES["op6_lm_scoring"](spark, sf).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert got[2] > 0 and got[0] > 1.2 * got[1]
