"""Regression metrics and interval calibration."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.functions.binning import segment_number
from evenkeel.functions.numeric import is_present
from evenkeel.operators.order_stats import column_quantiles, exact_quantiles, long_series

# Interval and low-segment settings.
METHOD = "segmented_relative_error_quantile"
ALPHA = 0.05
SEGMENTS = 5
MIN_SEGMENT_ROWS = 10
LOW_SHARE = 0.25

@dataclass(frozen=True)
class IntervalSpec:
    segment_edges: list[float] = field(default_factory=list)
    relative_error_quantiles_by_segment: list[float] = field(default_factory=list)
    relative_error_quantiles: dict[str, float] = field(default_factory=dict)
    calibration_size: int = 0
    alpha: float = ALPHA
    coverage: float = 1 - ALPHA
    num_segments: int = SEGMENTS
    method: str = METHOD


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """r2, rmse, mae, mse as one aggregate. A constant target gives r2 of 1 if all errors are 0, else 0.

    Every term is over the same rows: those that have both a target and a prediction (NaN is none).
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    both = df.where(is_present(y) & is_present(p))
    sums = both.agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("spread")
    )
    r2 = (
        F.when(F.col("spread") > 0, 1 - F.col("mse") / F.col("spread"))
        .when(F.col("mse") == 0, 1.0)
        .when(F.col("mse") > 0, 0.0)
    )
    return sums.select(r2.alias("r2"), F.sqrt("mse").alias("rmse"), "mae", "mse")


def low_segment_error(df: DataFrame, actual: str, predicted: str, cutoff: float | None) -> DataFrame:
    """Mean absolute error of the rows whose target is at most ``cutoff``."""
    y, p, limit = F.col(actual).cast("double"), F.col(predicted).cast("double"), F.lit(cutoff).cast("double")
    low = df.where(y <= limit).agg(F.avg(F.abs(y - p)).alias("cheap_segment_mae"))
    return low.withColumn("cheap_segment_cutoff_p25", limit)


def segment_mae(df: DataFrame, actual: str, predicted: str, share: float = LOW_SHARE) -> DataFrame:
    """Mean absolute error of the rows at or below the target's ``share`` quantile."""
    _, found = column_quantiles(df, actual, [share])
    return low_segment_error(df, actual, predicted, found[0] if found else None)


def relative_error(actual: Column, predicted: Column, normalizer: str = "actual") -> Column:
    """|y - max(p, 0)| over max(|y|, 1), or over the prediction where intervals must cover."""
    p = F.greatest(predicted, F.lit(0.0))
    if normalizer == "prediction":
        return F.when(p > 0, F.abs(actual - p) / p).otherwise(F.abs(actual))
    return F.abs(actual - p) / F.greatest(F.abs(actual), F.lit(1.0))


def rel_error_quantile(df: DataFrame, actual: str, predicted: str, alpha: float = ALPHA) -> tuple[int, float | None]:
    """Global "higher" quantile of the relative error at ``1 - alpha``."""
    size, found = column_quantiles(
        df, relative_error(F.col(actual).cast("double"), F.col(predicted).cast("double")), [1 - alpha], "higher"
    )
    return size, (found[0] if found else None)


def segment_edges(values: list[float]) -> list[float]:
    """Quantiles as non-decreasing edges."""
    return list(accumulate(values, max))


def segment_shares(segments: int) -> list[float]:
    return [i / segments for i in range(1, segments)]


def nonnegative(predicted: str) -> Column:
    return F.greatest(F.col(predicted).cast("double"), F.lit(0.0))


def calibrate_intervals(
    df: DataFrame,
    actual: str,
    predicted: str,
    alpha: float = ALPHA,
    segments: int = SEGMENTS,
    min_rows: int = MIN_SEGMENT_ROWS,
    normalizer: str = "actual",
    edges: list[float] | None = None,
) -> IntervalSpec:
    """Relative-error quantile per prediction segment, global where a segment is small.

    Two selections: the segment edges (unless given), then all segment quantiles and
    the global one together. Collected: one number per edge and per segment.
    """
    if edges is None:
        edges = segment_edges(column_quantiles(df, nonnegative(predicted), segment_shares(segments))[1])
    error = relative_error(F.col(actual).cast("double"), F.col(predicted).cast("double"), normalizer)
    scored = df.select(error.alias("error"), segment_number(nonnegative(predicted), edges).alias("segment"))
    series = long_series(scored, [(F.col("segment"), F.col("error")), (-1, F.col("error"))])
    found = exact_quantiles(series, [1 - alpha], "higher")
    if -1 not in found:
        raise ValueError("no rows to calibrate intervals on")
    size, (overall,) = found[-1]
    per_segment = [found[s][1][0] if s in found and found[s][0] >= min_rows else overall for s in range(segments)]
    return IntervalSpec(edges, per_segment, {"global": overall}, size, alpha, 1 - alpha, segments)


def interval_coverage(df: DataFrame, actual: str) -> DataFrame:
    """Share of rows whose target lies within ``lower_bound`` and ``upper_bound``."""
    inside = F.col(actual).between(F.col("lower_bound"), F.col("upper_bound"))
    return df.agg(F.avg(inside.cast("double")).alias("coverage"), F.count("*").alias("rows"))


def evaluate_predictions(df: DataFrame, actual: str, predicted: str, normalizer: str = "actual") -> tuple[dict, IntervalSpec]:
    """Test metrics and the interval calibrated on the same rows.

    The low-segment cutoff and the interval's edges come from one selection.
    """
    both = long_series(df, [(0, F.col(actual)), (1, nonnegative(predicted))])
    found = exact_quantiles(both, {0: [LOW_SHARE], 1: segment_shares(SEGMENTS)})
    if 1 not in found:
        raise ValueError("no rows to evaluate")
    spec = calibrate_intervals(df, actual, predicted, normalizer=normalizer, edges=segment_edges(found[1][1]))
    metrics = regression_metrics(df, actual, predicted).first().asDict()
    metrics |= low_segment_error(df, actual, predicted, found[0][1][0]).first().asDict()
    return {"test": metrics, "validation": None}, spec


def split_sizes(df: DataFrame) -> DataFrame:
    """train, validation (always none) and test row counts of a table with ``is_test``."""
    return df.agg(
        F.count_if(~F.col("is_test")).alias("train_size"),
        F.lit(0).cast("bigint").alias("val_size"),
        F.count_if("is_test").alias("test_size"),
    )
