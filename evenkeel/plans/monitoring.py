"""Drift run against the stored snapshot: first run, check, refresh."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from evenkeel.operators.drift import BINS, MODERATE, RESULT_SCHEMA, drift_check, drift_snapshot
from evenkeel.sources.snapshots import load_snapshot, save_snapshot

logger = logging.getLogger(__name__)


def run_drift_check(
    df: DataFrame, path: str, target: str, date: str | None, threshold: float = MODERATE, bins: int = BINS
) -> DataFrame:
    """One result row. The snapshot is saved on the first run, then only when retraining fires."""
    spark = df.sparkSession
    if target not in df.columns:
        raise ValueError(f"Column '{target}' not found. Available: {df.columns}")
    stored = load_snapshot(spark, path)
    if stored is None:
        now = drift_snapshot(df, target, date, bins)
        save_snapshot(spark, now, path)
        # Fixed format: the first run's result.
        row = (
            False,
            None,
            float(threshold),
            "no_reference",
            now.row_count,
            None,
            now.price_median,
            None,
            None,
            now.snapshot_date,
            "No reference snapshot exists. Current data saved as the new reference. "
            "Retraining skipped on this first run.",
        )
        return spark.createDataFrame([row], RESULT_SCHEMA)
    if not stored.usable:
        logger.warning("snapshot at %s has no bin edges: remove it to rebuild the reference", path)
    row = drift_check(df, target, date, stored, threshold).first()
    if row["should_retrain"]:
        save_snapshot(spark, drift_snapshot(df, target, date, bins), path)
    return spark.createDataFrame([tuple(row)], RESULT_SCHEMA)


