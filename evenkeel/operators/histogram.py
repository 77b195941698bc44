"""Histograms over explicit edges and the population stability index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.functions.binning import bin_number, segment_number
from evenkeel.functions.numeric import nan_to_null
from evenkeel.operators.order_stats import column_quantiles, exact_quantiles, long_series

EMPTY_SHARE = 1e-6
MIN_ROWS = 10


def unique_edges(df: DataFrame, column: str | Column, bins: int) -> tuple[int, list[float]]:
    """Row count and the distinct interpolated quantiles at 0, 1/bins, ..., 1."""
    size, values = column_quantiles(df, column, [i / bins for i in range(bins + 1)])
    return size, sorted(set(values))


def unique_edges_of(df: DataFrame, columns: Sequence[tuple[str | Column, int]]) -> list[tuple[int, list[float]]]:
    """``unique_edges`` of several columns, each with its number of bins, in one selection."""
    named = [(i, F.col(c) if isinstance(c, str) else c) for i, (c, _) in enumerate(columns)]
    steps = {i: [k / bins for k in range(bins + 1)] for i, (_, bins) in enumerate(columns)}
    found = exact_quantiles(long_series(df, named), steps)
    return [(found[i][0], sorted(set(found[i][1]))) if i in found else (0, []) for i in steps]


def with_bin(df: DataFrame, x: Column, edges: Sequence[float], clipped: bool) -> DataFrame:
    """Add ``bin``; out-of-range values are dropped into NULL, or clipped to the edge bins."""
    valued = df.withColumn("__x", nan_to_null(x.cast("double")))
    value = F.col("__x")
    # Clipping to the outer edges and testing the inner ones only are the same thing.
    number = segment_number(value, edges[1:-1]) + 1 if clipped else bin_number(value, edges)
    return valued.withColumn("bin", number).drop("__x")


def histogram(df: DataFrame, column: str | Column, edges: Sequence[float], clipped: bool = False) -> DataFrame:
    """(bin, low, high, count), one row per bin, empty bins included."""
    x = F.col(column) if isinstance(column, str) else column
    spark = df.sparkSession
    counts = with_bin(df, x, edges, clipped).where("bin IS NOT NULL").groupBy("bin").count()
    # One row per edge pair: bounded by the bin count, so the small side is known.
    frame = spark.createDataFrame(
        [(i + 1, float(edges[i]), float(edges[i + 1])) for i in range(len(edges) - 1)],
        "bin int, low double, high double",
    )
    joined = frame.join(F.broadcast(counts), "bin", "left")
    return joined.select("bin", "low", "high", F.coalesce("count", F.lit(0)).alias("count"))


def smoothed_share(count: Column, total: Column) -> Column:
    """Share of the total; a zero count becomes a tiny constant, nothing is renormalised."""
    return F.when(count == 0, F.lit(EMPTY_SHARE)).otherwise(count / total)


def psi_term(ref: Column, cur: Column) -> Column:
    return (ref - cur) * F.ln(ref / cur)


def psi(
    reference: DataFrame,
    current: DataFrame,
    column: str,
    bins: int = 10,
    log: bool = False,
    current_column: str | None = None,
) -> DataFrame:
    """One row: psi, ref_rows, cur_rows. Out-of-range current values are dropped.

    NULL where either side has under ten present values, or the reference is
    constant or too tied to give three edges. With ``log``, reference values at or below -1 are
    an error; current ones are below every edge, hence dropped with the rest out of range.
    """
    ref_x, cur_x = F.col(column), F.col(current_column or column)
    if log:
        refused = reference.agg(F.count_if(nan_to_null(ref_x.cast("double")) <= -1)).first()[0]
        if refused:
            raise ValueError(f"{refused} reference values are at or below -1")
        ref_x, cur_x = F.log1p(ref_x.cast("double")), F.log1p(cur_x.cast("double"))
    size, edges = unique_edges(reference, ref_x, bins)
    nb = len(edges) - 1
    if nb < 2 or size < MIN_ROWS:
        edges, nb, usable = [0.0, 1.0, 2.0], 2, F.lit(False)
    else:
        usable = F.lit(True)
    sides = None
    for side, df, x in (("r", reference, ref_x), ("c", current, cur_x)):
        tagged = df.select(nan_to_null(x.cast("double")).alias("x")).where("x IS NOT NULL")
        tagged = with_bin(tagged, F.col("x"), edges, clipped=False).select(F.lit(side).alias("side"), "bin")
        sides = tagged if sides is None else sides.unionAll(tagged)
    # At most 2 * (bins + 1) rows leave this aggregate.
    counted = sides.groupBy("side", "bin").agg(F.count("*").alias("n"))
    per_side = {
        s: [F.coalesce(F.sum(F.when((F.col("side") == s) & (F.col("bin") == i), F.col("n"))), F.lit(0)) for i in range(1, nb + 1)]
        for s in "rc"
    }
    row = counted.agg(
        F.array(*per_side["r"]).alias("r"),
        F.array(*per_side["c"]).alias("c"),
        F.coalesce(F.sum(F.when(F.col("side") == "r", F.col("n"))), F.lit(0)).alias("ref_rows"),
        F.coalesce(F.sum(F.when(F.col("side") == "c", F.col("n"))), F.lit(0)).alias("cur_rows"),
    )
    total = {s: F.aggregate(F.col(s), F.lit(0).cast("bigint"), lambda a, b: a + b) for s in "rc"}
    row = row.withColumn("rt", total["r"]).withColumn("ct", total["c"])
    terms = F.lit(0.0)
    for i in range(nb):
        terms = terms + psi_term(
            smoothed_share(F.col("r")[i], F.col("rt")), smoothed_share(F.col("c")[i], F.col("ct"))
        )
    enough = usable & (F.col("ref_rows") >= MIN_ROWS) & (F.col("cur_rows") >= MIN_ROWS)
    return row.select(F.when(enough, terms).alias("psi"), "ref_rows", "cur_rows")
