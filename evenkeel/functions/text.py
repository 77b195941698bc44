"""Display helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mask_middle(c: Column) -> Column:
    """Two characters at each end survive; up to four characters vanish. Empty gives NULL."""
    short = F.repeat(F.lit("*"), F.length(c))
    hidden = F.concat(F.left(c, F.lit(2)), F.lit("***"), F.right(c, F.lit(2)))
    return F.when(F.length(c) > 4, hidden).when(F.length(c) > 0, short)


def title_label(c: Column) -> Column:
    return F.initcap(F.translate(c, "_", " "))


def currency(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 0))


def percent(c: Column) -> Column:
    return F.concat(F.format_number(c, 1), F.lit("%"))
