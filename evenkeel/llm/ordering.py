"""A reproducible shuffled order within groups, and sums along it, with no group in one task.

Rows are ordered by the MD5 of their identity. A prefix of that text cuts every group into chunks
of about ``CHUNK_ROWS`` rows, and half of that prefix cuts them into coarse ones. The sum along the whole group is that
within a chunk, plus whole chunks before it in its coarse one, plus whole coarse ones before that: a group of 10^11 rows
has 4,096 coarse chunks of 65,536 chunks each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK_ROWS = 4000


def shuffled(df: DataFrame, identity: list[Column], rows: int) -> DataFrame:
    """``df`` with ``_order`` and the prefix ``_chunk``; ``rows`` is the size of ``df``."""
    digits = max(1, math.ceil(math.log(max(rows / CHUNK_ROWS, 1), 16)))
    parts = [F.coalesce(c.cast("string"), F.lit("-")) for c in identity]
    return df.withColumn("_order", F.md5(F.concat_ws("/", *parts).cast("binary"))).withColumn(
        "_chunk", F.substring("_order", 1, digits)
    )


def sum_before(df: DataFrame, group: str, value: str, ties: list[str]) -> DataFrame:
    """``df`` (from ``shuffled``) with ``_before``: the sum of ``value`` over the group's earlier rows.

    ``group`` holds no nulls. Rows equal in ``_order`` and ``ties`` are alike, so their order is free.
    """
    earlier = (Window.unboundedPreceding, -1)
    before = lambda *keys: F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(*earlier)), F.lit(0))
    coarse = F.expr("substring(_chunk, 1, length(_chunk) div 2)")
    chunks = df.groupBy(group, "_chunk").agg(F.sum(value).alias("_sum")).withColumn("_coarse", coarse)
    whole = chunks.groupBy(group, "_coarse").agg(F.sum("_sum").alias("_sum"))
    whole = whole.select(group, "_coarse", before(group, "_coarse").alias("_far"))
    near = chunks.select(group, "_chunk", "_coarse", before(group, "_coarse", "_chunk").alias("_near"))
    offsets = near.join(whole, [group, "_coarse"]).select(group, "_chunk", (F.col("_near") + F.col("_far")).alias("_offset"))
    inside = Window.partitionBy(group, "_chunk").orderBy("_order", *ties).rowsBetween(*earlier)
    summed = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        summed.join(offsets, [group, "_chunk"])
        .withColumn("_before", F.col("_offset") + F.col("_inside"))
        .drop("_offset", "_inside", "_chunk", "_order")
    )
