"""Text statistics and the discriminant against plain versions; held-out quality."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenkeel.llm.quality_qda import STATISTICS, THRESHOLD, calibrated, fit_discriminant, keep_good, score_quality, statistics
from evenkeel.llm.queries import QUERIES, quality_training


MOMENTS = {k: np.concatenate([[50.0], np.full(len(STATISTICS), 50.0 * k), 50.0 * (np.eye(len(STATISTICS)) + k).ravel()]) for k in (0, 1)}


def plain(text):
    text = text or ""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]

    def share(part, whole):
        return math.asin(math.sqrt(min(max(part / max(whole, 1), 0), 1)))

    kinds = ["#*$%&|<>@^~_=+\\{}[]", "!?", ".,;:", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "\n"]
    pairs = list(zip(words, words[1:]))
    return [
        math.log1p(len(words)),
        math.log1p(sum(map(len, words)) / max(len(words), 1)),
        *[share(sum(c in kind for c in text), len(text)) for kind in kinds],
        share(sum(a == b for a, b in pairs), len(words)),
        share(sum(len(w) == 1 for w in words), len(words)),
        share(len(set(words)), len(words)),
        share(len(set(pairs)), len(pairs)),
    ]


def test_statistics_equal_plain_version():
    texts = ["", None, "a", " \n", "One two two! THREE\nthree éé | 5", "x y " * 400_000, "same same same", "", "Ünï #*$ ok\n\n"]
    got = statistics(pa.array(texts, pa.string()))
    assert got.shape == (len(texts), len(STATISTICS))
    for row, text in zip(got, texts):
        assert row == pytest.approx(plain(text), abs=1e-9)
    assert statistics(pa.array(texts[2:], pa.string())[1:]) == pytest.approx(got[3:])


def test_discriminant_equals_densities():
    rng = np.random.default_rng(3)
    d, moments, groups = len(STATISTICS), {}, {}
    for k in (0, 1):
        x = rng.normal(k, 1 + k, (500, d)) @ rng.normal(0, 1, (d, d))
        groups[k] = x
        moments[k] = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
    model = fit_discriminant(moments, 0.0, 0.0)
    x = groups[0][:20]
    log = []
    for k in (0, 1):
        cov, away = np.cov(groups[k].T, bias=True), x - groups[k].mean(axis=0)
        log.append(-0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away) - 0.5 * np.linalg.slogdet(cov)[1])
    assert model.difference(x) == pytest.approx(np.arcsinh(log[1] - log[0]), rel=1e-6)


def test_cases(spark):
    good = [(i, f"plain words number {'abcdefgh'[i % 8]} follow each other here in order {i}", "x") for i in range(60)]
    bad = [(i, "!!! *** " * (5 + i % 7), "x") for i in range(100, 140)]
    odd = [(200, None, "x"), (201, "", "x"), (201, "", "x"), (None, "fine words here in a row", None)]
    docs = spark.createDataFrame(good + bad + odd, "doc_id bigint, text string, label string")
    labels = spark.createDataFrame([(r[0], int(r in good)) for r in good + bad] + [(0, None), (1, 1), (999, 1)], "doc_id bigint, quality int")
    rows = score_quality(docs, labels, quality_training()).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= THRESHOLD) for r in rows)
    got = {r["doc_id"]: r["predicted"] for r in rows}
    assert all(got[r[0]] for r in good) and not any(got[r[0]] for r in bad)
    kept = keep_good(docs, labels, quality_training())
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {d for d, p in got.items() if p}
    one_class = score_quality(docs, labels.where("quality = 1"), quality_training()).select("score").distinct().collect()
    assert len(one_class) == 1 and 0.9 < one_class[0][0] < 1
    assert {r["score"] for r in score_quality(docs, labels.limit(0), quality_training()).collect()} == {0.5}
    assert score_quality(docs.limit(0), labels, quality_training()).count() == 0


def test_query_is_right_on_held_out_rows(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op3_quality_classifier"](spark, folder).where("held_out").join(labels, "doc_id")
    by = {r["quality"]: r["p"] for r in got.groupBy("quality").agg(F.avg("predicted").alias("p")).collect()}
    assert by[1] > 0.97 and by[0] < 0.15


@pytest.mark.parametrize("name", ("stats", "score", "predicted"))
def test_clashing_names_are_refused(spark, name):
    docs = spark.createDataFrame([(1, "a", 2)], f"doc_id bigint, text string, {name} int")
    with pytest.raises(ValueError, match="exist already"):
        score_quality(docs, spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"), F.lit(True))


@pytest.mark.parametrize("bad, good, lost", [(-6.6, 4.9, 12), (-0.5, 0.5, 0), (-12.0, 12.0, 1), (3.0, 5.0, 2), (-40.0, 1.0, 3)])
def test_calibration_finds_the_curve_between_classes(bad, good, lost):
    """Far apart or near, shifted, and with a few good texts among the bad ones: the bad stay below the threshold."""
    spread = np.linspace(-0.4, 0.4, 9)
    bins = [(bad + d, 0, 250) for d in spread] + [(good + d, 1, 1600) for d in spread] + ([(bad + 1.2, 1, lost)] if lost else [])
    model = calibrated(fit_discriminant(MOMENTS, 0.1, 0.02), bins)
    score = lambda x: 1 / (1 + np.exp(-(model.slope * x + model.intercept)))
    assert score(bad) < 0.3 and score(good) > 0.9 and model.slope > 0
    # No other curve near it fits better.
    loss = lambda a, b: sum(w * np.logaddexp(0, -(2 * y - 1) * (a * x + b)) for x, y, w in bins) + 0.5e-3 * ((a - 1) ** 2 + b * b)
    best = loss(model.slope, model.intercept)
    assert all(loss(model.slope + da, model.intercept + db) >= best - 1e-6 for da in (-0.05, 0, 0.05) for db in (-0.05, 0, 0.05))
