"""Distribution drift against a stored snapshot."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, IntegerType, StringType, StructField, StructType

from evenkeel.functions.numeric import nan_to_null
from evenkeel.operators.histogram import EMPTY_SHARE, with_bin
from evenkeel.operators.order_stats import column_quantiles, exact_quantiles, long_series
from evenkeel.operators.sketches import merged_grid

# Drift levels on the stability index, and the default bin count.
MODERATE = 0.01
HIGH = 0.02
BINS = 10

# Fixed format: field names of the stored snapshot.
SNAPSHOT_SCHEMA = StructType(
    [
        StructField("snapshot_date", StringType()),
        StructField("row_count", LongType()),
        StructField("bins", IntegerType()),
        StructField("price_median", DoubleType()),
        StructField("price_mean", DoubleType()),
        StructField("price_std", DoubleType()),
        StructField("price_log_bin_edges", ArrayType(DoubleType())),
        StructField("price_log_ref_pct", ArrayType(DoubleType())),
        StructField("price_raw_quantiles", ArrayType(DoubleType())),
    ]
)

# Fixed format: fields of a drift result.
RESULT_SCHEMA = (
    "should_retrain boolean, psi double, psi_threshold double, drift_level string, "
    "current_row_count bigint, reference_row_count bigint, current_price_median double, "
    "reference_price_median double, reference_snapshot_date string, current_snapshot_date string, reason string"
)


@dataclass(frozen=True)
class DriftSnapshot:
    snapshot_date: str
    row_count: int
    bins: int
    price_median: float | None
    price_mean: float | None
    price_std: float | None
    price_log_bin_edges: list[float] = field(default_factory=list)
    price_log_ref_pct: list[float] = field(default_factory=list)
    price_raw_quantiles: list[float] = field(default_factory=list)

    def to_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([asdict(self)], SNAPSHOT_SCHEMA)

    @property
    def usable(self) -> bool:
        return len(self.price_log_bin_edges or []) >= 3 and bool(self.price_log_ref_pct)


def max_date(df: DataFrame, column: str | None) -> Column:
    """Newest date as text; "unknown" where the table has no date column."""
    if column is None or column not in df.columns:
        return F.lit("unknown")
    return F.max(F.to_date(column)).cast("string")


def logged_price(c: Column) -> Column:
    """log1p of the present values; those at or below -1 count as minus infinity, so clipping puts them in the first bin."""
    price = nan_to_null(c.cast("double"))
    return F.when(price <= -1, F.lit(float("-inf"))).otherwise(F.log1p(price))


def drift_snapshot(
    df: DataFrame, target: str, date: str | None, bins: int = BINS, sketches: DataFrame | None = None
) -> DriftSnapshot:
    """Summary of a table to compare later ones with. The table is read twice, whatever its size.

    ``sketches`` (from ``sketches.day_sketches``) of the table's days, or of any parts that make it up, bracket the
    quantiles, so that the first reading finds them. Values at or below -1 have no logarithm, hence no place in a reference: they are an error.
    Collected to the driver: one summary row and 3 * (bins + 1) numbers.
    """
    price = nan_to_null(F.col(target).cast("double"))
    series = long_series(df, [(0, F.log1p(price)), (1, price)])
    steps = [i / bins for i in range(bins + 1)]
    grids = None
    if sketches is not None:
        size, grid = merged_grid(sketches)
        if grid and grid[0] <= -1:
            raise ValueError(f"values of '{target}' are at or below -1")
        grids = {0: (size, [math.log1p(x) for x in grid]), 1: (size, grid)}
    values = exact_quantiles(series, {0: steps, 1: [0.5, *steps]}, grids=grids)
    if 0 not in values:
        raise ValueError(f"no present values above -1 in '{target}'")
    edges = sorted(set(values[0][1]))
    nb = len(edges) - 1
    counted = with_bin(df.withColumn("__p", price), F.log1p("__p"), edges, clipped=False)
    # One pass, one row: moments of the values and a conditional count per bin.
    row = counted.agg(
        F.count("*").alias("rows"),
        F.avg("__p").alias("mean"),
        F.stddev_samp("__p").alias("std"),
        max_date(df, date).alias("newest"),
        F.array(*[F.count_if(F.col("bin") == i) for i in range(1, nb + 1)]).alias("counts"),
        F.count_if(F.col("__p") <= -1).alias("refused"),
    ).first()
    if row["refused"]:
        raise ValueError(f"{row['refused']} values of '{target}' are at or below -1")
    total = sum(row["counts"])
    return DriftSnapshot(
        snapshot_date=row["newest"],
        row_count=row["rows"],
        bins=bins,
        price_median=values[1][1][0],
        price_mean=row["mean"],
        price_std=row["std"],
        price_log_bin_edges=edges,
        price_log_ref_pct=[n / total for n in row["counts"]],
        price_raw_quantiles=values[1][1][1:],
    )


def stored_psi(counts: list[Column], shares: list[float]) -> Column:
    """Index of current bin counts against stored shares; zero on either side is smoothed."""
    total = F.greatest(sum(counts[1:], counts[0]), F.lit(1))
    psi = F.lit(0.0)
    for n, share in zip(counts, shares, strict=True):
        ref = F.lit(share if share != 0 else EMPTY_SHARE)
        cur = F.when(n == 0, F.lit(EMPTY_SHARE)).otherwise(n / total)
        psi = psi + (ref - cur) * F.ln(ref / cur)
    return psi


def drift_level(psi: Column) -> Column:
    return (
        F.when(psi.isNull(), "unknown").when(psi >= HIGH, "high").when(psi >= MODERATE, "moderate").otherwise("none")
    )


def should_retrain(psi: Column, threshold: float) -> Column:
    """Needs both a level of at least moderate and the caller's threshold."""
    return F.coalesce((psi >= MODERATE) & (psi >= F.lit(threshold)), F.lit(False))


def drift_reason(level: Column, psi: Column, threshold: float) -> Column:
    # Fixed format: sentences of the drift result.
    verdict = F.when(should_retrain(psi, threshold), "triggered").otherwise("not triggered")
    value = F.format_string("%.4f", psi)
    drifted = F.concat(
        F.initcap(level), F.lit(" drift (PSI="), value, F.lit("). Retraining "), verdict, F.lit(f" (threshold={threshold}).")
    )
    quiet = F.concat(F.lit("No significant drift (PSI="), value, F.lit("). Retraining skipped."))
    return (
        F.when(level == "unknown", "PSI could not be computed. Retraining skipped as a safety measure.")
        .when(level == "none", quiet)
        .otherwise(drifted)
    )


def drift_check(
    df: DataFrame, target: str, date: str | None, snapshot: DriftSnapshot, threshold: float = MODERATE
) -> DataFrame:
    """One result row. Current values are clipped to the stored edges, also those without a logarithm.

    The table is read for one aggregate to at most bins + 1 groups, plus the
    selection passes of the exact median.
    """
    if target not in df.columns:
        raise ValueError(f"Column '{target}' not found. Available: {df.columns}")
    price = nan_to_null(F.col(target).cast("double"))
    _, median = column_quantiles(df, price, [0.5])
    dated = df.select(price.alias("__p"), *([F.col(date)] if date in df.columns else []))
    if snapshot.usable:
        binned = with_bin(dated, logged_price(F.col("__p")), snapshot.price_log_bin_edges, clipped=True)
    else:
        binned = dated.withColumn("bin", F.lit(None).cast("int"))
    per_bin = binned.groupBy("bin").agg(F.count("*").alias("n"), max_date(dated, date).alias("newest"))
    nb = len(snapshot.price_log_ref_pct or [])
    counts = [F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)) for i in range(1, nb + 1)]
    psi = stored_psi(counts, snapshot.price_log_ref_pct) if snapshot.usable else F.lit(None).cast("double")
    row = per_bin.agg(
        psi.alias("psi"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.max("newest").alias("newest")
    ).withColumn("level", drift_level(F.col("psi")))
    return row.select(
        should_retrain(F.col("psi"), threshold).alias("should_retrain"),
        "psi",
        F.lit(float(threshold)).alias("psi_threshold"),
        F.col("level").alias("drift_level"),
        F.col("rows").alias("current_row_count"),
        F.lit(snapshot.row_count).cast("bigint").alias("reference_row_count"),
        F.lit(median[0] if median else None).cast("double").alias("current_price_median"),
        F.lit(snapshot.price_median).cast("double").alias("reference_price_median"),
        F.lit(snapshot.snapshot_date).alias("reference_snapshot_date"),
        F.col("newest").alias("current_snapshot_date"),
        drift_reason(F.col("level"), F.col("psi"), threshold).alias("reason"),
    )
