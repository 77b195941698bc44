"""Wall time per headline query at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query's full result is produced and dropped (noop sink). A pass over the smallest
tables beforehand warms the JVM; training behind the scoring queries is timed as its own entry.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from evenkeel.catalog import QUERIES  # noqa: E402
from evenkeel.catalog.models import trained  # noqa: E402
from evenkeel.session import local_session  # noqa: E402

HEADLINE = (
    "drift_check",
    "drift_snapshot",
    "psi_log",
    "quantile_edges",
    "histogram",
    "drift_level",
    "stream_drift",
    "dedupe_full_row",
    "outlier_filter",
    "row_validation",
    "dim_backfill",
    "latest_per_key",
    "split_exact",
    "impute_median",
    "standardize",
    "feature_fit_transform",
    "fit_ridge",
    "fit_gbt",
    "train_run",
    "regression_metrics",
    "interval_calibration",
    "interval_apply",
    "batch_score",
    "stream_score",
    "promotion_gate",
    "register_version",
)


def run(spark, key: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = os.environ["BENCH_KEYS"].split(",") if os.environ.get("BENCH_KEYS") else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    small = str(Path(sf_dir).parent / "sf0.001")
    if Path(small).is_dir():
        for key in keys:
            run(spark, key, small)
    start = time.perf_counter()
    trained(spark, sf_dir)
    times = {"train_and_save": round(time.perf_counter() - start, 3)}
    times |= {key: run(spark, key, sf_dir) for key in keys}
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall", "value": total, "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
