"""Lookup joins against a dimension whose size is checked, not assumed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def lookup_join(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join on a unique dimension key.

    One bounded job measures at most ``BROADCAST_ROWS + 1`` dimension rows. Within the
    bounds on rows and on the bytes of all their columns the dimension is broadcast and the join is map-only;
    beyond them the join is left to the planner, whose adaptive skew handling splits a
    hot key's partition.
    """
    whole_row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in dim.columns])))
    width = F.coalesce(F.sum(whole_row), F.lit(0))
    rows, keys, size = dim.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.count_distinct(key), width).first()
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        if keys != rows:
            raise ValueError(f"lookup key '{key}' is not unique in the dimension")
        return df.join(F.broadcast(dim), key, "left")
    if dim.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"lookup key '{key}' is not unique in the dimension")
    return df.join(dim, key, "left")


def dim_backfill(df: DataFrame, dim: DataFrame, key: str, fills: Mapping[str, str]) -> DataFrame:
    """Fill each column of ``fills`` from its dimension column where missing.

    Columns are filled independently; an unknown key changes nothing; an absent
    column is created; without the key column the rows pass unchanged.
    """
    if key not in df.columns:
        return df
    side = dim.select(key, *[F.col(d).alias(f"__{c}") for c, d in fills.items()])
    joined = lookup_join(df, side, key)
    kinds = dict(df.dtypes)
    filled = {}
    for c in fills:
        found = F.col(f"__{c}").cast("double")
        if c not in kinds:
            filled[c] = found
        else:
            own = F.nanvl(F.col(c), F.lit(None)) if kinds[c] in ("double", "float") else F.col(c)
            filled[c] = F.coalesce(own, found)
    added = [c for c in fills if c not in kinds]
    return joined.withColumns(filled).select(*df.columns, *added)
