"""Exact quantiles of a column for every key of a table, whatever the number and the sizes of keys.

Nothing per key reaches the driver, and no key has to fit a task. The keys and values are written
once, narrow. Keys of more than ``SMALL`` rows get a sketch each, merged in two levels, from which
the wanted ranks are bracketed; the brackets are a table that values meet by a join on the key.
Values outside their key's brackets collapse to one counter per gap in every task, so that a few
hundredths of a large key remain. What remains is sorted by ranges of (key, gap, value) over all
tasks, a large key over many of them, and each range's running counts are shifted by the ranges
before it. That gives exact ranks. A rank that a sketch misplaced shows in the counters, and its
key is searched again with all of its values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from evenkeel.functions.numeric import is_present
from evenkeel.operators.order_stats import sketched
from evenkeel.session import materialize

SMALL = 4_000
GRID = 200
MARGIN = 2
ACCURACY = 1_000
MERGERS = 32


def key_of(keys: Sequence[str]) -> Column:
    """The key columns as one value, in which a missing column equals a missing one."""
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("key")


def key_columns(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"key.k{i}").alias(k) for i, k in enumerate(keys)]


def _ranks(probs: Sequence[float], method: str) -> Column:
    """The 0-based ranks that the quantiles of ``n`` values need."""
    last = F.col("n") - 1
    if method == "higher":
        wanted = [F.ceil(F.lit(p) * last) for p in probs]
    else:
        wanted = [r for p in probs for r in (F.floor(F.lit(p) * last), F.least(F.floor(F.lit(p) * last) + 1, last))]
    return F.array_sort(F.array_distinct(F.array(*[w.cast("bigint") for w in wanted])))


def _bracketed(values: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, brackets): for large keys the grid values around each wanted rank; null at an open end."""
    large = sizes.where(F.col("n") > SMALL)
    grids = sketched(values.join(large.select("key"), "key"), ["key"], "x", GRID, ACCURACY, MERGERS).select("key", "grid")

    def bracket(k: Column) -> Column:
        at = F.floor(k * F.lit(GRID) / F.col("n")).cast("int")
        low, high = at - MARGIN + 1, at + MARGIN
        return F.struct(
            F.when(low > 0, F.get("grid", low)).alias("low"), F.when(high < GRID, F.get("grid", high)).alias("high")
        )

    return large.join(grids, "key").select("key", F.transform("ranks", bracket).alias("brackets"))


def _collapsed(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """(key, code, v, c): counts of equal values inside brackets, and of all values of a gap outside (``v`` null).

    ``code`` is even for what lies between two bounds and odd for what equals one, in the order of values.
    """
    ends = F.flatten(F.transform("brackets", lambda b: F.array(b["low"], b["high"])))
    bounds = F.array_sort(F.array_distinct(F.array_compact(ends)))
    met = values.join(brackets.withColumn("bounds", bounds), "key", "left")
    below = F.size(F.filter("bounds", lambda b: b < F.col("x")))
    code = 2 * below + F.array_contains("bounds", F.col("x")).cast("int")
    inside = F.exists(
        "brackets",
        lambda b: (b["low"].isNull() | (F.col("x") > b["low"])) & (b["high"].isNull() | (F.col("x") < b["high"])),
    )
    free = F.col("brackets").isNull()
    coded = met.select(
        "key",
        F.when(free, F.lit(0)).otherwise(code).alias("code"),
        F.when(free | inside, F.col("x")).alias("v"),
    )
    return coded.groupBy("key", "code", "v").agg(F.count("*").alias("c"))


def _picked(collapsed: DataFrame, brackets: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, k, value, lost) for every wanted rank; ``lost`` where it fell among counters."""
    order = ["key", "code", "v"]
    dealt = collapsed.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = materialize(dealt.withColumn("part", F.spark_partition_id()), "keyed-ranges")
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy("key", "part").agg(F.sum("c").alias("total"))  # as many rows as keys and ranges together
    parts = parts.select("key", "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("key", "part").orderBy("code", "v")
    ranked = ranges.withColumn("upto", F.sum("c").over(inside)).join(parts, ["key", "part"])
    ranked = ranked.withColumn("upto", F.col("upto") + F.col("before"))
    hit = F.filter("ranks", lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("c")))
    found = ranked.join(sizes.select("key", "ranks"), "key").withColumn("k", F.explode(hit))
    if brackets is None:
        return found.select("key", "k", F.col("v").alias("value"), F.lit(False).alias("lost"))
    ends = F.flatten(F.transform("brackets", lambda b: F.array(b["low"], b["high"])))
    bounds = brackets.select("key", F.array_sort(F.array_distinct(F.array_compact(ends))).alias("bounds"))
    found = found.join(bounds, "key", "left")
    equal = F.get("bounds", F.expr("code div 2").cast("int"))
    value = F.when(F.col("code") % 2 == 1, equal).otherwise(F.col("v"))
    return found.select("key", "k", value.alias("value"), value.isNull().alias("lost"))


def _between(a: Column, b: Column, t: Column) -> Column:
    """Linear interpolation from the nearer end; next to an infinity the nearer neighbour, the lower one half-way."""
    finite = (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))
    line = F.when(t >= 0.5, b - (b - a) * (1 - t)).otherwise(a + (b - a) * t)
    return F.when(finite, line).when(t > 0.5, b).otherwise(a)


def keyed_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probs: Sequence[float],
    method: str = "linear",
    increasing: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The key columns, ``n`` (present values) and ``quantiles``, one per probability, for each key with a present value.

    ``linear`` interpolates between neighbouring values, ``higher`` takes the one at ``ceil(p * (n - 1))``.
    A missing key column is a key of its own. With a function that never falls, ``mapped`` has the quantiles of its results,
    which have the values' ranks and need no selection of their own.
    """
    if method not in ("linear", "higher"):
        raise ValueError(f"unknown method {method!r}")
    x = value.cast("double")
    values = materialize(df.select(key_of(keys), x.alias("x")).where(is_present(F.col("x"))), "keyed-values")
    sizes = values.groupBy("key").agg(F.count("*").alias("n")).withColumn("ranks", _ranks(probs, method))
    sizes = materialize(sizes, "keyed-sizes")
    brackets = materialize(_bracketed(values, sizes), "keyed-brackets")
    picked = materialize(_picked(_collapsed(values, brackets), brackets, sizes), "keyed-picked")
    if not picked.where("lost").isEmpty():
        lost = picked.where("lost").select("key").distinct()
        none = brackets.limit(0)
        again = _picked(_collapsed(values.join(lost, "key"), none), None, sizes.join(lost, "key"))
        picked = picked.join(lost, "key", "left_anti").unionByName(again)
    found = picked.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("at"))
    result = found.join(sizes.select("key", "n"), "key")
    last = F.col("n") - 1

    def quantile(p: float, of: Callable[[Column], Column]) -> Column:
        if method == "higher":
            return of(F.try_element_at("at", F.ceil(F.lit(p) * last).cast("bigint")))
        low = F.floor(F.lit(p) * last)
        a = of(F.try_element_at("at", low.cast("bigint")))
        b = of(F.try_element_at("at", F.least(low + 1, last).cast("bigint")))
        return _between(a, b, F.lit(p) * last - low)

    wanted = {"quantiles": lambda x: x} | ({"mapped": increasing} if increasing else {})
    return result.select(*key_columns(keys), "n", *[F.array(*[quantile(p, of) for p in probs]).alias(c) for c, of in wanted.items()])
