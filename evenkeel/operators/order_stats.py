"""Exact order statistics and quantiles of any number of rows.

``percentile`` keeps every distinct value of a column in one buffer and a global
sort sends the column through a shuffle. Here a mergeable sketch brackets the
wanted ranks, and only the values between the brackets are grouped and ranked.
Sketch error costs a further pass at worst, never exactness, because each pass
counts what lies outside its brackets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from evenkeel.functions.numeric import is_present
from evenkeel.session import materialize

GRID = 400
SKETCH_ACCURACY = 4_000
MERGERS = 512
BAND_LIMIT = 2_000_000
# Grid steps taken on each side of a rank: one for the grid, one for the merge.
MARGIN = 2


def long_series(df: DataFrame, columns: Sequence[tuple[int | Column, Column]]) -> DataFrame:
    """(series int, x double) with one row per present value of each given column.

    A series number may be a column, so one call also covers values per group.
    """
    pairs = [(F.lit(s) if isinstance(s, int) else s, c.cast("double")) for s, c in columns]
    if len(pairs) == 1:
        narrow = df.select(pairs[0][0].cast("int").alias("series"), pairs[0][1].alias("x"))
    else:
        narrow = df.select(
            F.inline(F.array(*[F.struct(s.cast("int").alias("series"), c.alias("x")) for s, c in pairs]))
        )
    return narrow.where(is_present(F.col("x")) & F.col("series").isNotNull())


@dataclass
class _Search:
    """What is known of one series: boundary values, and the ranks still sought."""

    size: int = 0
    bounds: list[float] = field(default_factory=list)
    open_gaps: set[int] = field(default_factory=lambda: {0})
    pending: list[int] = field(default_factory=list)
    found: dict[int, float] = field(default_factory=dict)

    def narrow(self, brackets: Iterable[tuple[float | None, float | None]]) -> None:
        """Keep only the bracket ends as bounds and reopen the gaps inside brackets."""
        brackets = list(brackets)
        self.bounds = sorted({b for pair in brackets for b in pair if b is not None})
        self.open_gaps = set()
        for low, high in brackets:
            first = 0 if low is None else self.bounds.index(low) + 1
            last = len(self.bounds) if high is None else self.bounds.index(high)
            self.open_gaps.update(range(first, last + 1))

    def gap_ends(self, gap: int) -> tuple[float | None, float | None]:
        low = self.bounds[gap - 1] if gap > 0 else None
        high = self.bounds[gap] if gap < len(self.bounds) else None
        return low, high


def _double(x: float) -> str:
    """A double as SQL text, infinities included."""
    return f"{x!r}D" if math.isfinite(x) else f"CAST('{x!r}' AS DOUBLE)"


def _placed(bounds: Sequence[float], first: int, last: int) -> str:
    """SQL for a binary search of ``x`` among the bounds, ending in an equality test with one of them."""
    if first == last:
        return "0" if first == 0 else f"IF(x = {_double(bounds[first - 1])}, {2 * first - 1}, {2 * first})"
    mid = (first + last) // 2
    return f"IF(x < {_double(bounds[mid])}, {_placed(bounds, first, mid)}, {_placed(bounds, mid + 1, last)})"


def _coded(series: DataFrame, searches: Mapping[int, _Search]) -> DataFrame:
    """Add ``code`` (even 2g: open gap g; odd 2i+1: equal to bound i) and ``v``.

    ``v`` holds the value inside a gap still searched and NULL elsewhere, so
    everything already placed collapses to one group per gap or bound before the
    shuffle, however often a value repeats.
    """
    code, sought = "CASE series", "CASE series"
    for number, search in searches.items():
        code += f" WHEN {number} THEN {_placed(search.bounds, 0, len(search.bounds))}"
        gaps = ", ".join(str(2 * g) for g in sorted(search.open_gaps))
        sought += f" WHEN {number} THEN code IN ({gaps})" if gaps else f" WHEN {number} THEN false"
    coded = series.where(F.col("series").isin(list(searches))).withColumn("code", F.expr(f"{code} END"))
    return coded.withColumn("v", F.expr(f"IF({sought} END, x, NULL)"))


def _evenly(steps: int) -> Column:
    """0, 1/steps, ..., 1 as one literal array."""
    return F.expr(f"array({', '.join(f'{i / steps!r}D' for i in range(steps + 1))})")


def sketched(
    df: DataFrame, keys: Sequence[str], value: str, steps: int, accuracy: int = SKETCH_ACCURACY, mergers: int = MERGERS
) -> DataFrame:
    """(keys, n, grid): row count and about evenly spaced quantiles of ``value`` per key.

    Sketches of all tasks would meet in one reducer per key. They are merged in
    ``mergers`` groups first, and the groups' quantiles are then merged by weight:
    at most mergers * (steps + 1) points per key. The group a task falls into
    shifts the estimate a little and nothing else.
    """
    grid = _evenly(steps)
    salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(mergers)))
    partial = salted.groupBy(*keys, "__salt").agg(
        F.count("*").alias("__n"),
        F.count(value).alias("__m"),
        F.percentile_approx(value, grid, accuracy).alias("__g"),
    )
    points = partial.select(*keys, "__n", "__m", F.posexplode_outer("__g").alias("__at", "__p"))
    counted = F.sum(F.when(F.coalesce("__at", F.lit(0)) == 0, F.col("__n")))
    return points.groupBy(*keys).agg(counted.alias("n"), F.percentile("__p", grid, F.col("__m")).alias("grid"))


def approximate_quantiles(df: DataFrame, column: Column, parts: int) -> list[float]:
    """Inner cut points that split a column into about equal parts; a value that fills several is repeated."""
    series = long_series(df, [(0, column)])
    row = sketched(series, ["series"], "x", parts).first()
    return sorted(row["grid"][1:-1]) if row else []


def _bracket(grid: Sequence[float], share: float, low: float | None, high: float | None):
    """Grid values on both sides of a rank given as a share; the gap's own ends near the edges."""
    at = int(share * GRID)
    first, last = at - MARGIN + 1, at + MARGIN
    return grid[first] if first > 0 else low, grid[last] if last < GRID else high


def _expected(rows: int, low: float | None, high: float | None) -> int:
    return 0 if low is not None and low == high else 2 * MARGIN * rows // GRID + 1


def _sketch_pass(series: DataFrame, searches: Mapping[int, _Search]) -> int:
    """Count every gap and bound, narrow around the pending ranks; estimated band rows."""
    rows: dict[int, list] = {}
    for r in sketched(_coded(series, searches), ["series", "code"], "v", GRID).collect():
        rows.setdefault(r["series"], []).append(r)
    band = 0
    for number, search in searches.items():
        brackets, below = [], 0
        wanted = sorted(search.pending)
        for r in sorted(rows.get(number, []), key=lambda r: r["code"]):
            here = [k for k in wanted if below <= k < below + r["n"]]
            ends = search.gap_ends(r["code"] // 2)
            if r["code"] % 2:
                search.found.update({k: search.bounds[r["code"] // 2] for k in here})
            elif here and r["grid"] is None:
                brackets.append(ends)
                band += r["n"]
            else:
                new = [_bracket(r["grid"], (k - below) / r["n"], *ends) for k in here]
                brackets += new
                band += sum(_expected(r["n"], *ends) for ends in new)
            below += r["n"]
        search.pending = [k for k in wanted if k not in search.found]
        if search.pending:
            search.narrow(brackets)
    return band


def _band_pass(series: DataFrame, searches: Mapping[int, _Search]) -> None:
    """Rank the values inside the open gaps and pick out the pending ranks."""
    ranks = "CASE series"
    for number, search in searches.items():
        ranks += f" WHEN {number} THEN array({', '.join(f'{k}L' for k in search.pending)})"
    here = F.filter(F.expr(f"{ranks} END"), lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n")))
    running = Window.partitionBy("series").orderBy("code", "v")
    picked = (
        _coded(series, searches)
        .groupBy("series", "code", "v")
        .agg(F.count("x").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("k", F.explode(here))
        .select("series", "code", "v", "k")
    )
    lost: dict[int, list] = {}
    for r in picked.collect():
        search = searches[r["series"]]
        if r["code"] % 2:
            search.found[r["k"]] = search.bounds[r["code"] // 2]
        elif r["v"] is not None:
            search.found[r["k"]] = r["v"]
        else:
            lost.setdefault(r["series"], []).append(search.gap_ends(r["code"] // 2))
    for number, search in searches.items():
        search.pending = [k for k in search.pending if k not in search.found]
        if search.pending:
            search.narrow(lost[number])


Grids = Mapping[int, tuple[int, Sequence[float]]]


def order_statistics(
    series: DataFrame, ranks_of, grids: Grids | None = None, stored: bool = False
) -> dict[int, tuple[int, dict[int, float]]]:
    """Exact values at 0-based ranks, per series.

    ``ranks_of(series_number, size)`` names the ranks once the size is known.
    The series are written first, two narrow columns that every pass reads, unless the caller says that they
    are ``stored`` already. With ``grids`` (size and ``GRID`` + 1 about evenly spaced quantiles per series, from
    sketches that were kept) the first pass is the exact one, over the source itself. Collected to the driver: per
    series, the grid of one sketch per searched gap and the values found. Series numbers are
    few (columns, segments), never keys.
    """
    searches: dict[int, _Search] = {}
    band = 0
    if grids is None:
        series = series if stored else materialize(series, "series")
        rows = [(r["series"], r["n"], r["grid"]) for r in sketched(series, ["series"], "x", GRID).collect()]
    else:
        rows = [(number, size, grid) for number, (size, grid) in grids.items() if size]
    for number, size, grid in rows:
        search = _Search(size=size, pending=sorted(set(ranks_of(number, size))))
        brackets = [_bracket(grid, k / size, None, None) for k in search.pending]
        band += sum(_expected(size, *ends) for ends in brackets)
        search.narrow(brackets)
        searches[number] = search
    while any(s.pending for s in searches.values()):
        active = {number: s for number, s in searches.items() if s.pending}
        if band > BAND_LIMIT:
            band = _sketch_pass(series, active)
        else:
            _band_pass(series, active)
            band = BAND_LIMIT + 1 if any(s.pending for s in active.values()) else 0
    return {number: (s.size, s.found) for number, s in searches.items()}


def _neighbours(p: float, size: int) -> tuple[int, int, float]:
    at = p * (size - 1)
    low = min(math.floor(at), size - 1)
    return low, min(low + 1, size - 1), at - low


def _between(a: float, b: float, t: float) -> float:
    """Linear interpolation, taken from the nearer end so it is exact at both.

    Next to an infinity there is no line: the nearer neighbour is taken, the lower one half-way.
    """
    if not (math.isfinite(a) and math.isfinite(b)):
        return b if t > 0.5 else a
    return b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t


def exact_quantiles(
    series: DataFrame,
    probs: Mapping[int, Sequence[float]] | Sequence[float],
    method: str = "linear",
    grids: Grids | None = None,
    stored: bool = False,
):
    """Quantiles per series, as {series: (size, [one value per probability])}.

    ``linear`` interpolates between the two neighbouring order statistics,
    ``higher`` takes the order statistic at ``ceil(p * (n - 1))``.
    """

    def wanted(number: int) -> Sequence[float]:
        return probs[number] if isinstance(probs, Mapping) else probs

    def ranks(number: int, size: int) -> list[int]:
        if method == "higher":
            return [math.ceil(p * (size - 1)) for p in wanted(number)]
        return [k for p in wanted(number) for k in _neighbours(p, size)[:2]]

    out = {}
    for number, (size, value) in order_statistics(series, ranks, grids, stored).items():
        if method == "higher":
            out[number] = (size, [value[math.ceil(p * (size - 1))] for p in wanted(number)])
        else:
            spots = [_neighbours(p, size) for p in wanted(number)]
            out[number] = (size, [_between(value[a], value[b], t) for a, b, t in spots])
    return out


def column_quantiles(df: DataFrame, column: str | Column, probs: Sequence[float], method: str = "linear") -> tuple[int, list[float]]:
    """Size and quantiles of one column; (0, []) where it has no present value."""
    c = F.col(column) if isinstance(column, str) else column
    return exact_quantiles(long_series(df, [(0, c)]), probs, method).get(0, (0, []))
