"""Numeric column helpers. Missing means NULL or NaN everywhere in this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def is_present(c: Column) -> Column:
    """Neither NULL nor NaN. The NULL half still reaches the parquet scan."""
    return c.isNotNull() & ~F.isnan(c)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, so both kinds of missing agree."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)).cast(df.schema[c].dataType) for c in floating})


def clip(c: Column, low: float, high: float) -> Column:
    """Bound ``c``; a NULL stays NULL (``least``/``greatest`` would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))
