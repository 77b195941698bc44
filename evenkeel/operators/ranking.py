"""Row numbers and exact-size splits without a global sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from evenkeel.functions.binning import segment_number
from evenkeel.operators.order_stats import approximate_quantiles, long_series, order_statistics
from evenkeel.session import materialize

# Fixed value: 13 hex digits are 52 bits, the most a double holds exactly.
HASH_DIGITS = 13


def row_hash(seed: int, key: Sequence[str]) -> Column:
    """md5 of ``seed:key``, the same text any SQL engine can build."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))


def _cut_ranks(share: float, size: int) -> list[int]:
    wanted = math.ceil(share * size)
    return [k for k in (wanted - 1, wanted) if 0 <= k < size]


def hash_number(seed: int, key: Sequence[str]) -> Column:
    """The leading digits of the row hash as a double, exact and in the same order."""
    return F.conv(F.left(row_hash(seed, key), F.lit(HASH_DIGITS)), 16, 10).cast("double")


def split_exact(df: DataFrame, test_share: float, seed: int, key: Sequence[str]) -> DataFrame:
    """Add ``is_test``: true for exactly ``ceil(share * n)`` rows, in hash order of the key."""
    return split_by_number(df.withColumn("__n", hash_number(seed, key)), "__n", test_share).drop("__n")


def split_by_number(df: DataFrame, number: str, test_share: float, stored: bool = False) -> DataFrame:
    """Add ``is_test`` to the ``ceil(share * n)`` rows with the smallest numbers.

    The number at that rank is found by selection, then each row compares with it:
    no sort, no shuffle of the rows. Only rows that hold that very number, where it
    straddles the cut, are ordered further, by a number from their whole content. ``stored``: the
    numbers are a column of a written table, not worked out anew by each pass.
    """
    series = long_series(df, [(0, F.col(number))])
    # The cut and the next rank: if they differ, no row ties with the cut across it.
    stats = order_statistics(series, lambda _, n: _cut_ranks(test_share, n), stored=stored)
    size, found = stats.get(0, (0, {}))
    return _cut_at(df, number, math.ceil(test_share * size), size, found)


def split_in_three(df: DataFrame, number: str, test_share: float, calibration_share: float, stored: bool = False) -> DataFrame:
    """Add ``part``: "test" for the ``ceil(test_share * n)`` rows with the smallest numbers, "calibration" for the next
    ``ceil(calibration_share * n)``, "train" for the rest.

    Both cuts come from one selection.
    """
    if not 0 <= test_share + calibration_share <= 1:
        raise ValueError("the shares add up to more than all rows")
    series = long_series(df, [(0, F.col(number))])
    ends = lambda n: (math.ceil(test_share * n), min(n, math.ceil(test_share * n) + math.ceil(calibration_share * n)))
    ranks = lambda _, n: sorted({k for e in ends(n) for k in (e - 1, e) if 0 <= k < n})
    size, found = order_statistics(series, ranks, stored=stored).get(0, (0, {}))
    low, high = ends(size)
    upper = _cut_at(df, number, high, size, found).withColumnRenamed("is_test", "__held")
    if low in (0, high) or low == size or found[low] > found[low - 1]:
        # No row ties with the lower cut across it.
        first = F.lit(low == high) if low in (0, high) else F.col(number) <= found[low - 1]
        first = F.lit(False) if low == 0 else first
        part = F.when(F.col("__held") & first, "test").when(F.col("__held"), "calibration").otherwise("train")
        return upper.withColumn("part", part).drop("__held")
    held = materialize(upper.where("__held").drop("__held"), "split-held")
    lower = _cut_at(held, number, low, high, {k: v for k, v in found.items() if k < high})
    tested = lower.withColumn("part", F.when(F.col("is_test"), "test").otherwise("calibration")).drop("is_test")
    return tested.unionByName(upper.where("NOT __held").drop("__held").withColumn("part", F.lit("train")))


def _cut_at(df: DataFrame, number: str, wanted: int, size: int, found: dict[int, float]) -> DataFrame:
    """Add ``is_test`` to ``wanted`` of ``size`` rows; ``found`` has the numbers at ranks ``wanted`` - 1 and ``wanted``."""
    if wanted == 0:
        return df.withColumn("is_test", F.lit(False))
    cut = found[wanted - 1]
    n = F.col(number)
    if wanted == size or found[wanted] > cut:
        return df.withColumn("is_test", n <= cut)
    # Copies of one key straddle the cut. A second number, from the whole row, orders them; rows
    # alike in that too are copies, of which any may go, so they get a running number per task.
    below = df.agg(F.count_if(n < cut)).first()[0]
    edge = materialize(
        df.where(n == cut).withColumn("__row", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("double")), "split-ties"
    )
    return df.where(n != cut).withColumn("is_test", n < cut).unionByName(_first_of(edge, wanted - below).drop("__row"))


def _first_of(edge: DataFrame, wanted: int) -> DataFrame:
    """Add ``is_test`` to ``wanted`` rows of ``edge``: those with the smallest ``__row``, then any copies."""
    stats = order_statistics(long_series(edge, [(0, F.col("__row"))]), lambda _, size: [wanted - 1] if 0 < wanted <= size else [], stored=True)
    size, found = stats[0]
    cut = found[wanted - 1]
    row = F.col("__row")
    below, copies = edge.agg(F.count_if(row < cut), F.count_if(row == cut)).first()
    apart = edge.where(row != cut).withColumn("is_test", row < cut)
    tied = edge.where(row == cut)
    if below + copies == wanted:
        return apart.unionByName(tied.withColumn("is_test", F.lit(True)))
    # The number of copies per task is counted, its earlier tasks' are added: no task sees them all.
    placed = materialize(
        tied.withColumn("__task", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "split-copies"
    )
    chunk = F.col("__task").cast("long") * (1 << 20) + F.floor(F.pmod("__at", F.lit(1 << 33)) / (1 << 16))
    chunked = placed.withColumn("__chunk", chunk)
    before = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunked.groupBy("__chunk").agg(F.count("*").alias("__size")).select(
        "__chunk", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy("__chunk").orderBy("__at")
    ranked = chunked.withColumn("__k", F.row_number().over(inside)).join(offsets, "__chunk")
    taken = ranked.withColumn("is_test", F.col("__k") + F.col("__before") <= wanted - below)
    return apart.unionByName(taken.drop("__task", "__at", "__chunk", "__k", "__before"))


def split_approximate(df: DataFrame, test_share: float, seed: int, key: Sequence[str]) -> DataFrame:
    """Add ``is_test`` by a hash threshold: map-only, size right to sampling error."""
    return df.withColumn("is_test", hash_number(seed, key) < test_share * 16.0**HASH_DIGITS)


def numbered_within(df: DataFrame, key: str, order: str, tiebreak: Sequence[str], name: str, slices: int = 256) -> DataFrame:
    """Row number within ``key`` by a numeric ``order`` column, safe for a hot key.

    A ranking window sends a whole key to one task. Here rows are first sliced by
    quantiles of the order column, numbered within (key, slice), and shifted by the
    number of rows in the key's earlier slices. An order value that fills more than one
    slice is sliced on by a hash of the tiebreak, which orders equal values everywhere.
    Slice bounds only balance the work, so where they fall never changes the numbers. Rows without
    a key are a group of their own.
    """
    cuts = approximate_quantiles(df, F.col(order), slices)
    full = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    value = F.col(order).cast("double")
    part = F.coalesce(segment_number(value, sorted(set(cuts))), F.lit(-1))
    # Rows without an order value are alike in it.
    tied = value.isNull() | (F.coalesce(value.isin(full), F.lit(False)) if full else F.lit(False))
    hashed = df.withColumn("__hash", F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in tiebreak]).cast("binary")))
    place = F.struct(part.alias("p"), (~tied).alias("o"), F.when(tied, F.substring("__hash", 1, 2)).otherwise("").alias("h"))
    sliced = hashed.withColumn("__slice", place)
    inner = Window.partitionBy(key, "__slice").orderBy(order, "__hash", *tiebreak)
    numbered = sliced.withColumn(name, F.row_number().over(inner))
    # At most a few times ``slices`` rows per key from here on.
    sizes = sliced.groupBy(key, "__slice").agg(F.count("*").alias("__size"))
    earlier = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
    offsets = offsets.select(F.col(key).alias("__key"), F.col("__slice").alias("__of"), "__before")
    shifted = numbered.join(offsets, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__slice") == F.col("__of")))
    return shifted.withColumn(name, F.col(name) + F.col("__before")).select(*df.columns, name)

