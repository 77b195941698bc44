"""Quantiles, drift and intervals of many keys against the single forms and numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.operators import keyed_quantiles as kq
from evenkeel.operators.drift import drift_check, drift_snapshot
from evenkeel.operators.evaluate import calibrate_intervals
from evenkeel.operators.intervals import segmented_interval
from evenkeel.operators.keyed_drift import keyed_calibration, keyed_drift, keyed_intervals, keyed_snapshots, refreshed_snapshots

PROBS = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]


def made(seed=1):
    rng = np.random.default_rng(seed)
    rows = [("hot", float(x)) for x in rng.normal(size=9000)] + [("tied", float(x)) for x in rng.integers(0, 3, 5000)]
    rows += [(f"k{i}", float(x)) for i in range(40) for x in rng.exponential(size=1 + i)] + [(None, 4.0), (None, 7.0)]
    return rows + [("k1", None), ("k2", float("nan")), ("empty", None), ("k3", float("inf"))]


def expected(rows, method):
    by = {}
    for k, x in rows:
        if x is not None and x == x:
            by.setdefault(k, []).append(x)
    how = {"linear": "linear", "higher": "higher"}[method]
    return {k: (len(v), [float(np.quantile(np.array(v), p, method=how)) for p in PROBS]) for k, v in by.items()}


@pytest.mark.parametrize("method", ("linear", "higher"))
@pytest.mark.parametrize("small", (4000, 5))
def test_equals_numpy(spark, monkeypatch, method, small):
    monkeypatch.setattr(kq, "SMALL", small)
    rows = [r for r in made() if r[1] != float("inf") or method == "higher"]
    df = spark.createDataFrame(rows, "key string, x double").repartition(5)
    got = {r["key"]: (r["n"], r["quantiles"]) for r in kq.keyed_quantiles(df, ["key"], F.col("x"), PROBS, method).collect()}
    want = expected(rows, method)
    assert set(got) == set(want)
    for k, (n, values) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(values, rel=1e-12)


def test_a_sketch_that_misses_is_repaired(spark, monkeypatch):
    monkeypatch.setattr(kq, "SMALL", 100)
    real = kq.sketched

    def wrong(df, keys, value, steps, *rest):
        return real(df, keys, value, steps, *rest).withColumn("grid", F.transform("grid", lambda x: x + 100))

    monkeypatch.setattr(kq, "sketched", wrong)
    rows = [r for r in made(2) if r[1] != float("inf")]
    df = spark.createDataFrame(rows, "key string, x double").repartition(5)
    got = {r["key"]: r["quantiles"] for r in kq.keyed_quantiles(df, ["key"], F.col("x"), PROBS).collect()}
    for k, (_, values) in expected(rows, "linear").items():
        assert got[k] == pytest.approx(values, rel=1e-12)


def test_drift_equals_the_single_form(spark):
    rng = np.random.default_rng(5)
    rows = [(k, float(x), f"2024-01-{1 + i % 28:02d}", i % 2) for k, shift in (("a", 0), ("b", 0.4), (None, 2)) for i, x in
            enumerate(np.exp(rng.normal(size=600) + 8 + shift * (np.arange(600) % 2)))]
    rows += [("new", 5.0, "2024-02-01", 1), ("gone", 5.0, "2024-02-01", 0), ("gone", 6.0, "2024-02-01", 0), ("low", -3.0, "2024-02-01", 0), ("low", 2.0, "2024-02-01", 1)]
    df = spark.createDataFrame(rows, "model string, price double, day string, side int")
    before, since = df.where("side = 0"), df.where("side = 1")
    stored = keyed_snapshots(before, ["model"], "price", "day")
    got = {r["model"]: r for r in keyed_drift(since, ["model"], "price", "day", stored).collect()}
    assert set(got) == {"a", "b", None, "new", "gone", "low"}
    for k in ("a", "b", None):
        same = F.col("model").eqNullSafe(F.lit(k))
        one = drift_snapshot(before.where(same), "price", "day")
        single = drift_check(since.where(same), "price", "day", one).first()
        for name in single.asDict():
            left, right = got[k][name], single[name]
            assert left == (pytest.approx(right, rel=1e-9) if isinstance(right, float) else right), (k, name)
    assert (got["new"]["drift_level"], got["new"]["should_retrain"]) == ("no_reference", False)
    assert got["low"]["drift_level"] == "unknown" and got["gone"]["current_row_count"] == 0
    drift = keyed_drift(since, ["model"], "price", "day", stored)
    after = refreshed_snapshots(stored, keyed_snapshots(since, ["model"], "price", "day"), drift, ["model"])
    counts = {r["model"]: r["row_count"] for r in after.collect()}
    assert set(counts) == set(got) and (counts["new"], counts["gone"], counts["low"]) == (1, 2, 1)


def test_intervals_equal_the_single_form(spark):
    rng = np.random.default_rng(6)
    rows = [(k, float(y), float(y * (1 + e))) for k in ("a", "b") for y, e in zip(rng.uniform(-5, 100, 300), rng.normal(size=300) * 0.2)]
    rows += [("few", float(y), float(y + 1)) for y in range(7)]
    df = spark.createDataFrame(rows, "model string, actual double, prediction double")
    specs = keyed_calibration(df, ["model"], "actual", "prediction")
    got = keyed_intervals(df, ["model"], specs)
    for k in ("a", "b", "few"):
        own = df.where(F.col("model") == k)
        spec = calibrate_intervals(own, "actual", "prediction")
        row = specs.where(F.col("model") == k).first()
        assert row["edges"] == pytest.approx(spec.segment_edges) and row["widths"] == pytest.approx(spec.relative_error_quantiles_by_segment)
        assert (row["overall"], row["calibration_size"]) == (pytest.approx(spec.relative_error_quantiles["global"]), spec.calibration_size)
        single = segmented_interval(own, spec).orderBy("prediction").collect()
        many = got.where(F.col("model") == k).orderBy("prediction").collect()
        assert [r["upper_bound"] for r in many] == pytest.approx([r["upper_bound"] for r in single])
        assert [r["lower_bound"] for r in many] == pytest.approx([r["lower_bound"] for r in single])
    other = spark.createDataFrame([("none", 1.0)], "model string, prediction double")
    assert keyed_intervals(other, ["model"], specs).first()["upper_bound"] is None


def test_quantiles_of_an_increasing_function_come_with_the_values(spark):
    rng = random.Random(3)
    rows = [(f"k{i % 3}", round(rng.expovariate(0.01), 2)) for i in range(9_000)] + [("big", float(i % 4_999)) for i in range(9_000)]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.0, 0.1, 0.37, 0.5, 1.0]
    both = {r["k"]: r for r in kq.keyed_quantiles(df, ["k"], F.col("x"), probs, increasing=F.log1p).collect()}
    apart = {r["k"]: r["quantiles"] for r in kq.keyed_quantiles(df, ["k"], F.log1p("x"), probs).collect()}
    plain = {r["k"]: r["quantiles"] for r in kq.keyed_quantiles(df, ["k"], F.col("x"), probs).collect()}
    assert {k: r["mapped"] for k, r in both.items()} == apart and {k: r["quantiles"] for k, r in both.items()} == plain
