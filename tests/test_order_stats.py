import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from evenkeel.operators import order_stats
from evenkeel.operators.drift import drift_snapshot
from evenkeel.operators.histogram import unique_edges, unique_edges_of
from evenkeel.operators.sketches import day_sketches, merged_grid
from evenkeel.operators.order_stats import column_quantiles, exact_quantiles, long_series
from evenkeel.operators.ranking import numbered_within, split_approximate, split_exact

PROBS = [i / 10 for i in range(11)] + [0.25, 0.95]


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)


@pytest.mark.parametrize("size, expected", [(10, 9), (20, 19), (100, 95), (476, 452)])
def test_higher_quantile(spark, size, expected):
    assert column_quantiles(frame(spark, range(size)), "x", [0.95], "higher") == (size, [float(expected)])


@pytest.fixture
def tiny_sketch(monkeypatch):
    """Sketches so coarse, and bands so small, that every kind of pass is needed."""
    monkeypatch.setattr(order_stats, "GRID", 10)
    monkeypatch.setattr(order_stats, "SKETCH_ACCURACY", 10)
    monkeypatch.setattr(order_stats, "BAND_LIMIT", 50)


@pytest.mark.parametrize("kind", ["spread", "hot", "constant", "signed", "bins"])
def test_matches_numpy_through_many_passes(spark, tiny_sketch, kind):
    rng = np.random.default_rng(7)
    values = {
        "spread": rng.lognormal(size=3000),
        "hot": np.concatenate([np.full(1500, 3.0), rng.normal(size=1500)]),
        "constant": np.full(2000, 5.0),
        "signed": np.concatenate([rng.normal(size=1000), [0.0, -0.0, 1e300, -1e300]]),
        "bins": rng.integers(0, 7, 3000),
    }[kind]
    size, found = column_quantiles(frame(spark, values), "x", PROBS)
    assert size == len(values)
    np.testing.assert_allclose(found, np.quantile(values.astype(float), PROBS), rtol=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_matches_numpy_on_any_values(spark, values):
    _, found = column_quantiles(frame(spark, values), "x", [0.0, 0.3, 0.5, 1.0])
    np.testing.assert_allclose(found, np.quantile(values, [0.0, 0.3, 0.5, 1.0]), rtol=1e-9, atol=1e-9)


def test_missing_values_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,), (float("nan"),)], "x double")
    assert column_quantiles(df, "x", [0.5]) == (4, [2.5])
    assert column_quantiles(df.where("x IS NULL"), "x", [0.5]) == (0, [])


def test_several_series_at_once(spark):
    df = frame(spark, range(100)).withColumn("g", (F.col("x") % 3).cast("int"))
    found = exact_quantiles(long_series(df, [(F.col("g"), F.col("x")), (-1, F.col("x"))]), [0.5])
    assert found[-1] == (100, [49.5])
    assert found[0] == (34, [49.5])


def test_split_is_exact_and_stable(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    one = split_exact(df, 0.2, 42, ["k"])
    two = split_exact(df.repartition(7), 0.2, 42, ["k"])
    assert one.where("is_test").count() == 201
    assert one.exceptAll(two).count() == 0
    assert split_exact(df, 0.2, 43, ["k"]).exceptAll(one).count() > 0


def test_split_size_holds_when_a_key_repeats(spark):
    df = spark.range(900).select((F.col("id") % 3).alias("k"), "id")
    assert split_exact(df, 0.5, 1, ["k"]).where("is_test").count() == 450


def test_split_size_holds_for_a_key_that_identifies_nothing(spark):
    df = spark.range(101).withColumn("k", F.lit(1))
    assert split_exact(df, 0.5, 1, ["k"]).where("is_test").count() == 51
    assert split_exact(df.select("k"), 0.5, 1, ["k"]).where("is_test").count() == 51


def test_split_edges(spark):
    df = spark.range(10)
    assert split_exact(df, 0.0, 1, ["id"]).where("is_test").count() == 0
    assert split_exact(df, 1.0, 1, ["id"]).where("is_test").count() == 10
    assert split_exact(df.limit(0), 0.2, 1, ["id"]).count() == 0
    assert 0 < split_approximate(spark.range(1000), 0.2, 1, ["id"]).where("is_test").count() < 400


def test_numbering_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"), "id")
    out = numbered_within(df, "k", "id", [], "n").where("k = -1").orderBy("id").select("n").toPandas()["n"]
    assert list(out) == list(range(1, 2001))


def test_numbering_a_hot_key_whose_order_values_are_all_equal(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), F.lit(7).alias("o"), F.col("id").cast("string").alias("r"))
    out = numbered_within(df, "k", "o", ["r"], "n")
    assert sorted(r["n"] for r in out.collect()) == list(range(1, 3001))
    again = numbered_within(df.repartition(5), "k", "o", ["r"], "n", slices=4)
    assert out.exceptAll(again).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__slice" in plan


def counted_rows(spark, n):
    """A table that counts how many of its rows are read."""
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    made = spark.range(n).select((F.col("id") * 7919 % 10007).cast("double").alias("x"), F.lit("2024-01-01").alias("d"))
    return made.repartition(4).mapInPandas(passed, made.schema), read


@pytest.mark.parametrize("kept", (False, True))
def test_a_snapshot_reads_its_table_twice(spark, monkeypatch, kept):
    monkeypatch.setattr("evenkeel.operators.order_stats.BAND_LIMIT", 400)  # several passes of selection
    df, read = counted_rows(spark, 20_000)
    plain = drift_snapshot(df, "x", "d")
    assert read.value == 2 * 20_000
    if kept:
        sketches = day_sketches(df, F.col("x"), F.pmod("x", F.lit(5)))
        monkeypatch.undo()
        sketches = spark.createDataFrame(sketches.collect(), "day string, sketch binary")
        before = read.value
        assert drift_snapshot(df, "x", "d", sketches=sketches) == plain
        assert read.value - before == 2 * 20_000


def test_wrong_sketches_cost_passes_only(spark):
    df, _ = counted_rows(spark, 3000)
    other = day_sketches(df.withColumn("x", F.col("x") + 5e5), F.col("x"), F.lit("a"))
    assert drift_snapshot(df, "x", "d", sketches=other) == drift_snapshot(df, "x", "d")
    assert merged_grid(other.limit(0)) == (0, [])


def test_edges_of_several_columns(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"), F.lit(None).cast("double").alias("c"))
    both = unique_edges_of(df, [("a", 10), ("b", 4), ("c", 5)])
    assert both == [unique_edges(df, "a", 10), unique_edges(df, "b", 4), (0, [])]
