"""Row and column cleaning of wide tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from evenkeel.contract import Contract, require_columns
from evenkeel.functions.numeric import is_present, without_nan

logger = logging.getLogger(__name__)


def dedupe_full_row(df: DataFrame) -> DataFrame:
    """Distinct rows over every source column.

    Run before any column is dropped: rows that differ only in an id or a date are
    different rows. Copies collapse in the map-side half of the aggregate, so one
    row with many copies does not load one reducer; later row filters move below it.
    """
    return without_nan(df).dropDuplicates()


def drop_if_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def select_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Features then target, in contract order; absent columns are an error."""
    require_columns(df, contract.training_columns, "training columns")
    return df.select(*contract.training_columns)


def exclude_categories(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop rows holding one of ``values``; a missing category is kept."""
    if not values or column not in df.columns:
        return df
    return df.where(F.col(column).isNull() | ~F.col(column).isin(list(values)))


def cast_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cast to double. With ANSI mode on (Spark's default) text that is no number fails the job."""
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def range_condition(target: str, area: str, low: float, high: float, min_area: float) -> Column:
    """Inclusive bounds that fail on a missing value; plain comparisons, so scans can push them."""
    t, a = F.col(target).cast("double"), F.col(area).cast("double")
    return (t >= low) & (t <= high) & (a >= min_area) & ~F.isnan(a)


def outlier_filter(
    df: DataFrame,
    target: str,
    area: str,
    low: float,
    high: float,
    min_area: float,
    enabled: bool = True,
    removed: Observation | None = None,
) -> DataFrame:
    """Business-range filter. ``removed`` receives the dropped-row count without a second pass."""
    if not enabled:
        return df
    if target not in df.columns:
        raise ValueError(f"no column {target!r} to filter by range")
    if area not in df.columns:
        logger.warning("range filter skipped: no column %s", area)
        return df
    keep = range_condition(target, area, low, high, min_area)
    if removed is not None:
        df = df.observe(removed, F.count_if(~F.coalesce(keep, F.lit(False))).alias("removed"))
    return df.where(keep)


def clean(df: DataFrame, contract: Contract, exclude: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Dedupe, drop, exclude, cast, in that order."""
    df = drop_if_present(dedupe_full_row(df), contract.drop)
    for column, values in (exclude or {}).items():
        df = exclude_categories(df, column, values)
    return cast_numeric(df, contract.numeric)


def present_only(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose value is missing."""
    if dict(df.dtypes)[column] in ("double", "float"):
        return df.where(is_present(F.col(column)))
    return df.where(F.col(column).isNotNull())


def latest_per_key(df: DataFrame, key: str | Sequence[str], date: str, tiebreak: Sequence[str]) -> DataFrame:
    """Newest row per key by ``date``, then by the tiebreak columns.

    An aggregate rather than a ranking window: each task keeps one row per key
    before the shuffle, so a key with a third of all rows stays cheap.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(date, *tiebreak)
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("newest"))
    return newest.select(*keys, "newest.*").select(*df.columns)
