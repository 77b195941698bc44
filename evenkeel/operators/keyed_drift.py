"""Drift, calibration and intervals of many models at once: one row per key, no loop and no code per key.

The single-model forms are in ``drift``, ``evaluate`` and ``intervals``. Here edges, shares and
widths are arrays in a table with one row per key, which rows meet by a join on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.functions.numeric import nan_to_null
from evenkeel.operators.drift import BINS, MODERATE, drift_level, drift_reason, logged_price, max_date, should_retrain
from evenkeel.operators.evaluate import ALPHA, MIN_SEGMENT_ROWS, SEGMENTS, nonnegative, relative_error, segment_shares
from evenkeel.operators.histogram import psi_term, smoothed_share
from evenkeel.operators.keyed_quantiles import key_columns, key_of, keyed_quantiles
from evenkeel.session import materialize

REFERENCE = ("snapshot_date", "row_count", "median", "mean", "std", "log_edges", "log_shares", "raw_quantiles")


def _bins_passed(x: Column, edges: str) -> Column:
    """How many inner edges are at most ``x``: the 0-based bin, values beyond the outer edges in the outer bins."""
    inner = F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.size(F.filter(inner, lambda e: e <= x))


def _counts(binned: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """(key, name): the number of rows per bin as an array, empty bins included; rows without a bin don't count."""
    per_bin = binned.where("bin IS NOT NULL").groupBy("key", "bin").agg(F.count("*").alias("n"))
    found = per_bin.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    joined = edges.select("key", "edges").join(found, "key", "left")
    filled = F.transform(
        F.sequence(F.lit(0), F.size("edges") - 2), lambda b: F.coalesce(F.try_element_at("found", b), F.lit(0))
    )
    return joined.where(F.size("edges") > 1).select("key", filled.alias(name))


def _total(counts: str) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, b: a + b)


def keyed_snapshots(df: DataFrame, keys: Sequence[str], target: str, date: str, bins: int = BINS) -> DataFrame:
    """The key columns and a reference summary per key (``REFERENCE``).

    A key with a value at or below -1, which has no logarithm, or without any value gets no edges and no shares: it can be
    no reference. Shares are unsmoothed.
    """
    price = nan_to_null(F.col(target).cast("double"))
    rows = materialize(df.select(key_of(keys), price.alias("x"), F.col(date).alias("day")), "keyed-rows")
    steps = [i / bins for i in range(bins + 1)]
    # One selection for the values and their logarithms; only keys whose values all have one use the latter.
    found = materialize(keyed_quantiles(rows, ["key"], F.col("x"), [*steps, 0.5], increasing=F.log1p), "keyed-quantiles")
    moments = rows.groupBy("key").agg(
        max_date(rows, "day").alias("snapshot_date"),
        F.count("*").alias("row_count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.count_if(F.col("x") <= -1).alias("refused"),
    )
    logs = found.select("key", F.array_distinct(F.slice("mapped", 1, bins + 1)).alias("edges"))
    usable = logs.join(moments.where("refused = 0").select("key"), "key")
    binned = rows.join(usable, "key").withColumn("bin", F.when(F.col("x").isNotNull(), _bins_passed(F.log1p("x"), "edges")))
    shares = _counts(binned, usable, "counts").withColumn("total", _total("counts"))
    shares = shares.select("key", F.transform("counts", lambda n: n / F.col("total")).alias("log_shares"))
    raw = found.select(
        "key", F.get("quantiles", F.lit(bins + 1)).alias("median"), F.slice("quantiles", 1, bins + 1).alias("raw_quantiles")
    )
    out = moments.join(raw, "key", "left").join(usable.withColumnRenamed("edges", "log_edges"), "key", "left")
    out = out.join(shares, "key", "left")
    return out.select(*key_columns(keys), *REFERENCE)


def keyed_drift(
    df: DataFrame, keys: Sequence[str], target: str, date: str, snapshots: DataFrame, threshold: float = MODERATE
) -> DataFrame:
    """A drift result per key of either side, against ``snapshots`` (from ``keyed_snapshots``).

    Values are clipped to the stored edges. A key without a snapshot is a first run: level
    ``no_reference``, nothing to retrain. One whose snapshot has fewer than three edges is ``unknown``. One without current rows
    is judged like an empty table.
    """
    price = nan_to_null(F.col(target).cast("double"))
    rows = materialize(df.select(key_of(keys), price.alias("x"), F.col(date).alias("day")), "keyed-rows")
    stored = snapshots.select(key_of(keys), *REFERENCE).withColumn("edges", F.col("log_edges"))
    usable = stored.where(F.size("edges") >= 3)
    met = rows.join(usable.select("key", "edges"), "key")
    binned = met.withColumn("bin", F.when(F.col("x").isNotNull(), _bins_passed(logged_price(F.col("x")), "edges")))
    medians = keyed_quantiles(rows, ["key"], F.col("x"), [0.5]).select("key", F.get("quantiles", F.lit(0)).alias("now_median"))
    now = rows.groupBy("key").agg(F.count("*").alias("now_rows"), max_date(rows, "day").alias("now_date"))
    joined = now.join(medians, "key", "left").join(stored, "key", "full").join(_counts(binned, usable, "counts"), "key", "left")
    total = F.greatest(_total("counts"), F.lit(1))
    zero = F.lit(0.0)
    terms = F.zip_with(
        "log_shares", "counts", lambda share, n: psi_term(smoothed_share(share, F.lit(1.0)), smoothed_share(n, total))
    )
    psi = F.when(F.col("counts").isNotNull(), F.aggregate(terms, zero, lambda a, b: a + b))
    first = F.col("row_count").isNull()
    joined = joined.withColumn("psi", psi)
    level = F.when(first, "no_reference").otherwise(drift_level(F.col("psi")))
    reason = F.when(first, F.lit("No reference: the current rows become it.")).otherwise(drift_reason(level, F.col("psi"), threshold))
    return joined.select(
        *key_columns(keys),
        should_retrain(F.col("psi"), threshold).alias("should_retrain"),
        "psi",
        F.lit(float(threshold)).alias("psi_threshold"),
        level.alias("drift_level"),
        F.coalesce("now_rows", F.lit(0)).alias("current_row_count"),
        F.col("row_count").alias("reference_row_count"),
        F.col("now_median").alias("current_price_median"),
        F.col("median").alias("reference_price_median"),
        F.col("snapshot_date").alias("reference_snapshot_date"),
        F.col("now_date").alias("current_snapshot_date"),
        reason.alias("reason"),
    )


def refreshed_snapshots(stored: DataFrame, current: DataFrame, drift: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The references from now on: the current ones of keys that retrain or had none, the stored ones of all others.

    A key without current rows keeps its reference.
    """
    moved = drift.where(F.col("should_retrain") | (F.col("drift_level") == "no_reference")).select(key_of(keys))
    taken = current.select(key_of(keys), *REFERENCE).join(moved, "key", "left_semi")
    kept = stored.select(key_of(keys), *REFERENCE).join(taken.select("key"), "key", "left_anti")
    return kept.unionByName(taken).select(*key_columns(keys), *REFERENCE)


def keyed_calibration(
    df: DataFrame,
    keys: Sequence[str],
    actual: str,
    predicted: str,
    alpha: float = ALPHA,
    segments: int = SEGMENTS,
    min_rows: int = MIN_SEGMENT_ROWS,
    normalizer: str = "actual",
) -> DataFrame:
    """Per key: ``edges`` of the prediction segments, ``widths`` per segment, ``overall`` and the number of rows.

    As ``evaluate.calibrate_intervals`` for one model: a segment with few rows takes the overall width.
    """
    error = relative_error(F.col(actual).cast("double"), F.col(predicted).cast("double"), normalizer)
    rows = materialize(df.select(key_of(keys), nonnegative(predicted).alias("level"), error.alias("error")), "keyed-errors")
    cuts = keyed_quantiles(rows, ["key"], F.col("level"), segment_shares(segments))
    running = lambda i: F.array_max(F.slice("quantiles", 1, i + 1))
    edges = materialize(cuts.select("key", F.array(*[running(i) for i in range(segments - 1)]).alias("edges")), "keyed-edges")
    segment = F.size(F.filter("edges", lambda e: e <= F.col("level")))
    placed = rows.join(edges, "key").withColumn("segment", F.explode(F.array(segment, F.lit(-1))))
    found = keyed_quantiles(placed, ["key", "segment"], F.col("error"), [1 - alpha], "higher")
    listed = found.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("segment", F.struct("n", F.get("quantiles", F.lit(0)).alias("q"))))).alias("by")
    )
    overall = F.try_element_at("by", F.lit(-1))
    widths = F.transform(
        F.sequence(F.lit(0), F.lit(segments - 1)),
        lambda s: F.when(F.try_element_at("by", s)["n"] >= min_rows, F.try_element_at("by", s)["q"]).otherwise(overall["q"]),
    )
    out = edges.join(listed, "key")
    return out.select(*key_columns(keys), "edges", widths.alias("widths"), overall["q"].alias("overall"), overall["n"].alias("calibration_size"))


def keyed_intervals(df: DataFrame, keys: Sequence[str], specs: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``df`` with lower_bound and upper_bound by its key's calibration; both null where the key has none."""
    spec = specs.select(key_of(keys).alias("__key"), F.col("edges").alias("__edges"), F.col("widths").alias("__widths"))
    level = F.greatest(F.col(prediction), F.lit(0.0))
    met = df.withColumn("__own", key_of(keys)).join(spec, F.col("__own") == F.col("__key"), "left")
    width = F.get("__widths", F.size(F.filter("__edges", lambda e: e <= level)))
    bounds = {"lower_bound": F.greatest(F.lit(0.0), level * (1 - width)), "upper_bound": level * (1 + width)}
    bounds = {c: F.when(F.col("__key").isNotNull(), v) for c, v in bounds.items()}
    return met.withColumns(bounds).drop("__own", "__key", "__edges", "__widths")
