import dataclasses
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.operators.drift import DriftSnapshot, drift_check, drift_level, drift_snapshot, should_retrain
from evenkeel.operators.histogram import histogram, psi
from evenkeel.plans.monitoring import run_drift_check
from evenkeel.session import scratch_path
from evenkeel.sources.snapshots import load_snapshot, save_snapshot
from evenkeel.streaming.ledger import Ledger
from evenkeel.streaming.drift import compact_window_counts, start_window_counts, window_counts

# A published snapshot.
EDGES = [
    7.601402334583733, 12.57763689161664, 12.781281858244437, 12.886643575525625, 12.978950256431569,
    13.098072734013513, 13.217493541006709, 13.356637800091326, 13.566529639502244, 13.997832781424618,
    17.216707972959764,
]
SHARES = [
    0.10057708161582853, 0.09975267930750206, 0.09315746084089035, 0.10634789777411377, 0.09975267930750206,
    0.09975267930750206, 0.10057708161582853, 0.09975267930750206, 0.09975267930750206, 0.10057708161582853,
]
STORED = DriftSnapshot("2026-03-01", 1213, 10, 488000.0, 822283.8252267106, 1924594.0059964266, EDGES, SHARES, [])


def test_small_table_against_a_stored_snapshot(listings):
    prices = np.array([r["price"] for r in listings.collect()])
    counts, _ = np.histogram(np.clip(np.log1p(prices), EDGES[0], EDGES[-1]), EDGES)
    now = np.where(counts == 0, 1e-6, counts / counts.sum())
    expected = float(((np.array(SHARES) - now) * np.log(np.array(SHARES) / now)).sum())
    row = drift_check(listings, "price", None, STORED).first()
    assert row["psi"] == pytest.approx(expected, rel=1e-12)
    assert (row["drift_level"], row["should_retrain"]) == ("high", True)
    assert row["reason"] == f"High drift (PSI={expected:.4f}). Retraining triggered (threshold=0.01)."
    assert (row["current_price_median"], row["current_snapshot_date"]) == (float(np.median(prices)), "unknown")


def test_values_without_a_logarithm(spark):
    bad = spark.createDataFrame([(-5.0,), (-1.0,), *[(float(v),) for v in range(1, 40)]], "price double")
    with pytest.raises(ValueError, match="2 values"):
        drift_snapshot(bad, "price", None)
    with pytest.raises(ValueError, match="2 reference values"):
        psi(bad, bad, "price", log=True)
    # A check counts them in the first bin, like any value below the reference.
    low = bad.withColumn("price", F.when(F.col("price") < 0, 0.0).otherwise(F.col("price")))
    assert drift_check(bad, "price", None, STORED).first()["psi"] == drift_check(low, "price", None, STORED).first()["psi"]


def test_a_half_written_snapshot_is_not_a_first_run(spark, tmp_path):
    path = tmp_path / "reference"
    (path / "snapshot=0").mkdir(parents=True)
    with pytest.raises(ValueError, match="no complete snapshot"):
        load_snapshot(spark, str(path))
    save_snapshot(spark, STORED, str(path))
    (path / "snapshot=7").mkdir()
    assert load_snapshot(spark, str(path)) == STORED
    assert load_snapshot(spark, str(tmp_path / "absent")) is None


def test_stream_counts_every_row_however_late(spark):
    rows = spark.range(4000).select(
        F.timestamp_seconds(F.col("id") * 4320).alias("ts"), (F.col("id") % 97 + 1).cast("double").alias("value")
    )
    source, target, checkpoint = (scratch_path(spark, x) for x in ("late", "windows", "cp"))
    for k in (3, 2, 1, 0):
        rows.where(F.floor(F.col("value") * 0) + F.floor(F.unix_timestamp("ts") / (4320 * 1000)) == k).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    start_window_counts(stream, "ts", "value", STORED, target, checkpoint).awaitTermination()
    by_window = lambda: {r["start"]: r["n"] for r in window_counts(spark, target).groupBy("start").agg(F.sum("n").alias("n")).collect()}
    before = by_window()
    assert sum(before.values()) == 4000 and len(before) == 200
    compact_window_counts(spark, target)
    assert by_window() == before
    rows.limit(10).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    start_window_counts(stream, "ts", "value", STORED, target, checkpoint).awaitTermination()
    assert sum(by_window().values()) == 4010
    # Another checkpoint over the same files counts them again, after a compaction as before one.
    stream = spark.readStream.schema(rows.schema).parquet(source)
    start_window_counts(stream, "ts", "value", STORED, target, scratch_path(spark, "cp")).awaitTermination()
    assert sum(by_window().values()) == 8020
    compact_window_counts(spark, target)
    assert sum(by_window().values()) == 8020 and compact_window_counts(spark, target) == compact_window_counts(spark, target)


def test_a_replayed_batch_counts_once(spark):
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    first, second = (ledger.fresh_folder("added") for _ in range(2))
    for folder in (first, second):
        spark.range(5).write.parquet(folder)
    assert ledger.rows("added") is None
    assert ledger.commit("s", 0, {"added": first}) and not ledger.commit("s", 0, {"added": second})
    assert ledger.holds("s", 0) and not ledger.holds("s", 1) and not ledger.holds("t", 0)
    assert [e.folders["added"] for e in ledger.entries()] == [first] and ledger.entries({"s": 0}) == []
    assert ledger.rows("added").count() == 5


def test_snapshot_without_edges_is_unknown(listings):
    row = drift_check(listings, "price", None, dataclasses.replace(STORED, price_log_bin_edges=[])).first()
    assert (row["psi"], row["drift_level"], row["should_retrain"]) == (None, "unknown", False)


@pytest.mark.parametrize(
    "value, threshold, level, retrain",
    [(None, 0.01, "unknown", False), (0.02, 0.01, "high", True), (0.019, 0.01, "moderate", True), (0.0099, 0.001, "none", False), (0.03, 0.05, "high", False)],
)
def test_levels(spark, value, threshold, level, retrain):
    c = F.lit(value).cast("double")
    assert tuple(spark.range(1).select(drift_level(c), should_retrain(c, threshold)).first()) == (level, retrain)


def test_psi_is_zero_on_itself_and_never_negative(spark):
    rng = np.random.default_rng(3)
    a = spark.createDataFrame([(float(v),) for v in rng.normal(size=500)], "x double")
    b = spark.createDataFrame([(float(v),) for v in rng.normal(1, 2, size=500)], "x double")
    assert psi(a, a, "x").first()["psi"] == pytest.approx(0, abs=1e-15)
    assert psi(a, b, "x").first()["psi"] > 0


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(4)
    ref, cur = rng.lognormal(size=400), rng.lognormal(0.3, 1.2, size=300)
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    r, c = (np.histogram(v, edges)[0] for v in (ref, cur))
    rs, cs = (np.where(n == 0, 1e-6, n / n.sum()) for n in (r, c))
    frames = [spark.createDataFrame([(float(v),) for v in side], "x double") for side in (ref, cur)]
    assert psi(*frames, "x").first()["psi"] == pytest.approx(float(((rs - cs) * np.log(rs / cs)).sum()), rel=1e-12)


def test_histogram_drops_or_clips_outsiders(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 1.0, 2.0, 2.5, None, float("nan"))], "x double")
    counts = lambda clipped: [r["count"] for r in histogram(df, "x", [0.0, 1.0, 2.0], clipped).orderBy("bin").collect()]
    assert counts(False) == [1, 2]
    assert counts(True) == [2, 3]


def test_snapshot_counts_missing_prices_as_rows(spark):
    rows = [(float(v), "2024-03-0%d" % (v % 9 + 1)) for v in range(1, 21)] + [(None, "2024-05-01")]
    snap = drift_snapshot(spark.createDataFrame(rows, "price double, d string"), "price", "d")
    values = np.arange(1.0, 21)
    assert (snap.row_count, snap.snapshot_date, snap.price_median) == (21, "2024-05-01", 10.5)
    assert snap.price_std == pytest.approx(values.std(ddof=1))
    np.testing.assert_allclose(snap.price_log_bin_edges, np.quantile(np.log1p(values), np.linspace(0, 1, 11)))
    assert math.isclose(sum(snap.price_log_ref_pct), 1)


def test_first_run_then_refresh_only_on_drift(spark):
    path = scratch_path(spark, "reference")
    base = spark.range(1, 500).select((F.col("id") * 1000.0).alias("price"), F.lit("2024-01-01").alias("d"))
    same = base.withColumn("d", F.lit("2024-02-01"))
    moved = base.select((F.col("price") * 3).alias("price"), F.lit("2024-03-01").alias("d"))
    first = run_drift_check(base, path, "price", "d").first()
    assert (first["drift_level"], first["should_retrain"], first["psi"]) == ("no_reference", False, None)
    assert run_drift_check(same, path, "price", "d").first()["drift_level"] == "none"
    assert load_snapshot(spark, path).snapshot_date == "2024-01-01"
    assert run_drift_check(moved, path, "price", "d").first()["should_retrain"]
    assert load_snapshot(spark, path).snapshot_date == "2024-03-01"


def test_indented_snapshot_file_loads(spark, tmp_path):
    import json

    path = tmp_path / "drift_reference.json"
    path.write_text(json.dumps(dataclasses.asdict(STORED), indent=2))
    assert load_snapshot(spark, str(path)) == STORED
