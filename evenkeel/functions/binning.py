"""Value -> interval number, as nested comparisons that stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _cuts_passed(x: Column, cuts: Sequence[float], first: int, last: int) -> Column:
    if first == last:
        return F.lit(first)
    mid = (first + last) // 2
    return F.when(x < F.lit(float(cuts[mid])), _cuts_passed(x, cuts, first, mid)).otherwise(
        _cuts_passed(x, cuts, mid + 1, last)
    )


def segment_number(x: Column, cuts: Sequence[float]) -> Column:
    """0-based half-open segment of ``x``: how many of the sorted cuts are <= x.

    log2(len(cuts)) comparisons a row, no array and no lookup join. NULL gives NULL.
    """
    return F.when(x.isNotNull(), _cuts_passed(x, cuts, 0, len(cuts)))


def bin_number(x: Column, edges: Sequence[float]) -> Column:
    """1-based histogram bin over explicit edges; the last bin is closed on both ends.

    Values outside the edges give NULL, as does NULL.
    """
    inside = (x >= F.lit(float(edges[0]))) & (x <= F.lit(float(edges[-1])))
    return F.when(inside, _cuts_passed(x, edges[1:-1], 0, len(edges) - 2) + 1)
