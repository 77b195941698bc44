"""Named queries, each with the SQL that any engine should agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query '{key}' is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str, exprs: tuple[str, ...]) -> DataFrame:
    """A table seen through expressions that mean the same in both engines."""
    return table(spark, sf_dir, name).selectExpr(*exprs)


def derived_sql(name: str, exprs: tuple[str, ...]) -> str:
    return f"(SELECT {', '.join(exprs)} FROM {name})"


def rounded(c: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# Day as text, so that no engine's date type matters.
ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING) AS day"
SHIP_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING) AS day"

# Orders with a missing price for one priority.
PRICED = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS price",
    ORDER_DAY,
)

# Orders with a stand-in prediction that is wrong by a varying share and sometimes negative.
PREDICTED = (
    "o_orderkey",
    "o_totalprice AS actual",
    "o_totalprice * (CAST(0.6 AS DOUBLE) + CAST(0.9 AS DOUBLE) * (CAST((o_orderkey * 7919) % 997 AS DOUBLE) "
    "/ CAST(996 AS DOUBLE))) - CAST(20000 AS DOUBLE) AS prediction",
)
