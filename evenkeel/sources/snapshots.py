"""Drift snapshots as JSON.

Each save is a new folder ``snapshot=N`` under the path; the newest complete one is the snapshot,
so a writer that dies leaves the one before it in force.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from evenkeel.operators.drift import SNAPSHOT_SCHEMA, DriftSnapshot
from evenkeel.sources.folders import exists, newest_complete, next_number


def save_snapshot(spark: SparkSession, snapshot: DriftSnapshot, path: str) -> None:
    number = next_number(spark, path, "snapshot")
    snapshot.to_frame(spark).coalesce(1).write.json(f"{path}/snapshot={number}")


def load_snapshot(spark: SparkSession, path: str) -> DriftSnapshot | None:
    """The stored snapshot: of a path that was saved to, or one indented file; None if the path isn't there.

    A path without a complete snapshot is an error: taking it for a first run would silently
    make today's data the reference.
    """
    if not exists(spark, path):
        return None
    number = newest_complete(spark, path, "snapshot")
    source = path if number is None else f"{path}/snapshot={number}"
    row = spark.read.schema(SNAPSHOT_SCHEMA).option("recursiveFileLookup", number is None).json(source, multiLine=True).first()
    if row is None or row["price_log_bin_edges"] is None:
        raise ValueError(f"{path} exists but holds no complete snapshot")
    return DriftSnapshot(**row.asDict())
