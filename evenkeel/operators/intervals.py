"""Prediction intervals: absolute ``lower_bound`` / ``upper_bound`` columns, map-only."""

from __future__ import annotations

import logging
import math

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.functions.binning import segment_number
from evenkeel.functions.text import currency, percent
from evenkeel.operators.estimators import inner_model
from evenkeel.operators.evaluate import METHOD, IntervalSpec

logger = logging.getLogger(__name__)


def _pick(number: Column, values: list[float]) -> Column:
    """values[number] as a chain over the few segments."""
    out = F.lit(None).cast("double")
    for i, v in enumerate(values):
        out = F.when(number == i, F.lit(float(v))).otherwise(out)
    return out


def segment_width(level: Column, spec: IntervalSpec) -> Column | None:
    """Relative width per row, or None where the specification supports no lookup."""
    edges, widths = spec.segment_edges, spec.relative_error_quantiles_by_segment
    if widths and len(edges) == len(widths) - 1:
        return _pick(segment_number(level, edges), widths)
    named = spec.relative_error_quantiles
    if len(edges) == 2 and named:
        overall = float(named.get("global", 0.0))
        bands = [float(named.get(k, overall)) for k in ("low", "mid", "high")]
        return F.when(level < edges[0], bands[0]).when(level < edges[1], bands[1]).otherwise(bands[2])
    return None


def segmented_interval(df: DataFrame, spec: IntervalSpec, prediction: str = "prediction") -> DataFrame | None:
    """Bounds at max(p, 0) * (1 -/+ width), never below zero."""
    if spec.method != METHOD:
        return None
    width = segment_width(F.col("__level"), spec)
    if width is None:
        return None
    leveled = df.withColumn("__level", F.greatest(F.col(prediction), F.lit(0.0))).withColumn("__width", width)
    return leveled.withColumns(
        {
            "lower_bound": F.greatest(F.lit(0.0), F.col("__level") * (1 - F.col("__width"))),
            "upper_bound": F.col("__level") * (1 + F.col("__width")),
        }
    ).drop("__level", "__width")


def flat_interval(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """No support for uncertainty: both bounds equal the prediction."""
    logger.warning("no interval support for this model: flat bounds")
    return df.withColumns({"lower_bound": F.col(prediction), "upper_bound": F.col(prediction)})


def _percentile_of(values: Column, size: int, p: float) -> Column:
    at = p * (size - 1)
    low = math.floor(at)
    a, b = F.get(values, F.lit(low)), F.get(values, F.lit(min(low + 1, size - 1)))
    return a + (b - a) * F.lit(at - low)


def forest_interval(pipeline: PipelineModel, df: DataFrame, log_target: bool = True) -> DataFrame:
    """2.5 and 97.5 percentiles over the trees' predictions, on the target's scale.

    Every tree is applied in the same projection, so a row's tree values never leave
    its task. Only for forests: the stages of a boosted model predict residuals.
    """
    forest = inner_model(pipeline)
    if not isinstance(forest, RandomForestRegressionModel):
        raise ValueError("tree intervals need a random forest")
    scored = df
    for stage in pipeline.stages[:-2]:
        scored = stage.transform(scored)
    names = [f"__tree_{i}" for i in range(len(forest.trees))]
    for name, tree in zip(names, forest.trees):
        scored = tree.setPredictionCol(name).setFeaturesCol("features").transform(scored)
    values = F.array(*[F.expm1(n) if log_target else F.col(n) for n in names])
    scored = forest.transform(scored.withColumn("__sorted", F.array_sort(values)).drop(*names))
    scored = pipeline.stages[-1].transform(scored)
    return scored.withColumns(
        {
            "lower_bound": _percentile_of(F.col("__sorted"), len(names), 0.025),
            "upper_bound": _percentile_of(F.col("__sorted"), len(names), 0.975),
        }
    ).drop("__sorted")


def predict_with_interval(
    pipeline: PipelineModel, spec: IntervalSpec | None, df: DataFrame, log_target: bool = True
) -> DataFrame:
    """Score, then the first interval kind that applies: segmented, forest, flat."""
    if spec is not None:
        bounded = segmented_interval(pipeline.transform(df), spec)
        if bounded is not None:
            return bounded
    if isinstance(inner_model(pipeline), RandomForestRegressionModel):
        return forest_interval(pipeline, df, log_target)
    return flat_interval(pipeline.transform(df))


def interval_report(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Display form: amounts, margin and margin in percent of the prediction."""
    margin = (F.col("upper_bound") - F.col("lower_bound")) / 2
    share = F.when(F.col(prediction) != 0, margin / F.col(prediction) * 100)
    return df.withColumns(
        {
            "margin": margin,
            "prediction_text": currency(F.col(prediction)),
            "lower_text": currency(F.col("lower_bound")),
            "upper_text": currency(F.col("upper_bound")),
            "margin_text": F.concat(currency(margin), F.lit(" (±"), percent(share), F.lit(")")),
        }
    )
