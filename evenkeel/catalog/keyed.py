"""Quantiles, drift and intervals of hundreds of models in one go."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.catalog.drift import CUT
from evenkeel.catalog.registry import derived, derived_sql, query, rounded
from evenkeel.operators.keyed_drift import keyed_calibration, keyed_drift, keyed_intervals, keyed_snapshots, refreshed_snapshots
from evenkeel.operators.keyed_quantiles import keyed_quantiles

# A model per supplier and flag; one model without a supplier, one flag without prices, and one model per size from a hot one down.
SOLD = (
    "CASE WHEN l_suppkey % 7 < 2 THEN NULL ELSE l_suppkey END AS supplier",
    "l_returnflag AS flag",
    "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL ELSE l_extendedprice END AS price",
    "l_shipdate",
)
SOLD_SQL = derived_sql("lineitem", SOLD)
MODEL = ("supplier", "flag")
STEPS = ", ".join(str(i / 10) for i in range(11))


@query(
    "quantiles_by_key",
    f"""WITH q AS (SELECT supplier, flag, count(*) AS n, quantile_cont(price, [0.0, 0.25, 0.5, 0.95, 1.0]) AS q,
          list_sort(list(price)) AS s FROM {SOLD_SQL} WHERE price IS NOT NULL GROUP BY supplier, flag)
        SELECT supplier, flag, n, round(q[1], 6) AS low, round(q[2], 6) AS p25, round(q[3], 6) AS median, round(q[4], 6) AS p95,
          round(q[5], 6) AS high, s[CAST(ceil(CAST(0.95 AS DOUBLE) * (n - 1)) AS BIGINT) + 1] AS p95_higher FROM q""",
)
def _(spark, sf):
    df = derived(spark, sf, "lineitem", SOLD)
    linear = keyed_quantiles(df, MODEL, F.col("price"), [0.0, 0.25, 0.5, 0.95, 1.0])
    higher = keyed_quantiles(df, MODEL, F.col("price"), [0.95], "higher").withColumnRenamed("quantiles", "above")
    same = [linear[k].eqNullSafe(higher[k]) for k in MODEL]
    names = ("low", "p25", "median", "p95", "high")
    return linear.join(higher, same).select(
        *[linear[k] for k in MODEL],
        linear["n"],
        *[F.round(F.get("quantiles", F.lit(i)), 6).alias(name) for i, name in enumerate(names)],
        F.get("above", F.lit(0)).alias("p95_higher"),
    )


DRIFTED = f"""ref AS (SELECT * FROM {SOLD_SQL} WHERE l_shipdate < TIMESTAMP '{CUT}'),
cur AS (SELECT * FROM {SOLD_SQL} WHERE l_shipdate >= TIMESTAMP '{CUT}'),
e AS (SELECT supplier, flag, list_sort(list_distinct(quantile_cont(ln(1 + price), [{STEPS}]))) AS e FROM ref
  WHERE price IS NOT NULL GROUP BY supplier, flag),
b AS (SELECT supplier, flag, e, unnest(range(len(e) - 1)) AS bin FROM e WHERE len(e) >= 2),
rc AS (SELECT ref.supplier, ref.flag, len(list_filter(e[2:len(e) - 1], lambda x: x <= ln(1 + price))) AS bin, count(*) AS n
  FROM ref JOIN e ON e.supplier IS NOT DISTINCT FROM ref.supplier AND e.flag = ref.flag WHERE price IS NOT NULL GROUP BY ALL),
cc AS (SELECT cur.supplier, cur.flag, len(list_filter(e[2:len(e) - 1], lambda x: x <= ln(1 + price))) AS bin, count(*) AS n
  FROM cur JOIN e ON e.supplier IS NOT DISTINCT FROM cur.supplier AND e.flag = cur.flag WHERE price IS NOT NULL GROUP BY ALL),
shares AS (SELECT b.supplier, b.flag, len(b.e) AS edges, b.bin, coalesce(rc.n, 0) AS rn, coalesce(cc.n, 0) AS cn,
    sum(coalesce(rc.n, 0)) OVER w AS rt, greatest(sum(coalesce(cc.n, 0)) OVER w, 1) AS ct
  FROM b LEFT JOIN rc ON rc.supplier IS NOT DISTINCT FROM b.supplier AND rc.flag = b.flag AND rc.bin = b.bin
  LEFT JOIN cc ON cc.supplier IS NOT DISTINCT FROM b.supplier AND cc.flag = b.flag AND cc.bin = b.bin
  WINDOW w AS (PARTITION BY b.supplier, b.flag)),
smooth AS (SELECT supplier, flag, edges, CASE WHEN rn = 0 THEN 1e-6::DOUBLE ELSE rn / CAST(rt AS DOUBLE) END AS r,
    CASE WHEN cn = 0 THEN 1e-6::DOUBLE ELSE cn / CAST(ct AS DOUBLE) END AS c FROM shares),
psi AS (SELECT supplier, flag, sum((r - c) * ln(r / c)) AS psi FROM smooth WHERE edges >= 3 GROUP BY supplier, flag),
refs AS (SELECT supplier, flag, count(*) AS n, median(price) AS median, max(CAST(l_shipdate AS DATE)) AS day FROM ref GROUP BY supplier, flag),
curs AS (SELECT supplier, flag, count(*) AS n, median(price) AS median, max(CAST(l_shipdate AS DATE)) AS day FROM cur GROUP BY supplier, flag),
drift AS (SELECT coalesce(refs.supplier, curs.supplier) AS supplier, coalesce(refs.flag, curs.flag) AS flag, psi,
    CASE WHEN refs.n IS NULL THEN 'no_reference' WHEN psi IS NULL THEN 'unknown' WHEN psi >= 0.02 THEN 'high'
      WHEN psi >= 0.01 THEN 'moderate' ELSE 'none' END AS drift_level,
    coalesce(psi >= 0.01, false) AS should_retrain, coalesce(curs.n, 0) AS current_row_count, refs.n AS reference_row_count,
    round(curs.median, 6) AS current_price_median, round(refs.median, 6) AS reference_price_median,
    CAST(refs.day AS VARCHAR) AS reference_snapshot_date, CAST(curs.day AS VARCHAR) AS current_snapshot_date
  FROM refs FULL JOIN curs ON refs.supplier IS NOT DISTINCT FROM curs.supplier AND refs.flag = curs.flag
  LEFT JOIN psi ON psi.supplier IS NOT DISTINCT FROM coalesce(refs.supplier, curs.supplier) AND psi.flag = coalesce(refs.flag, curs.flag))"""


@query("drift_by_model", f"WITH {DRIFTED} SELECT * REPLACE (round(psi, 9) AS psi) FROM drift")
def _(spark, sf):
    df = derived(spark, sf, "lineitem", SOLD)
    stored = keyed_snapshots(df.where(f"l_shipdate < TIMESTAMP_NTZ '{CUT}'"), MODEL, "price", "l_shipdate")
    drift = keyed_drift(df.where(f"l_shipdate >= TIMESTAMP_NTZ '{CUT}'"), MODEL, "price", "l_shipdate", stored)
    shown = {c: rounded(c, 9 if c == "psi" else 6) for c in ("psi", "current_price_median", "reference_price_median")}
    return drift.withColumns(shown).drop("psi_threshold", "reason")


@query(
    "references_by_model",
    f"""WITH {DRIFTED}
        SELECT supplier, flag, CASE WHEN (should_retrain OR reference_row_count IS NULL) AND current_row_count > 0 THEN current_row_count
          ELSE reference_row_count END AS row_count, CASE WHEN (should_retrain OR reference_row_count IS NULL) AND current_row_count > 0
          THEN current_price_median ELSE reference_price_median END AS median FROM drift""",
)
def _(spark, sf):
    df = derived(spark, sf, "lineitem", SOLD)
    since = df.where(f"l_shipdate >= TIMESTAMP_NTZ '{CUT}'")
    stored = keyed_snapshots(df.where(f"l_shipdate < TIMESTAMP_NTZ '{CUT}'"), MODEL, "price", "l_shipdate")
    current = keyed_snapshots(since, MODEL, "price", "l_shipdate")
    drift = keyed_drift(since, MODEL, "price", "l_shipdate", stored)
    return refreshed_snapshots(stored, current, drift, MODEL).select(*MODEL, "row_count", rounded("median").alias("median"))


# A model per group of customers, with a stand-in prediction; some models have few rows in a segment.
JUDGED = (
    "o_orderkey",
    "CAST(o_custkey % 89 AS BIGINT) * CAST(CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS model",
    "o_totalprice AS actual",
    "o_totalprice * (CAST(0.6 AS DOUBLE) + CAST(0.9 AS DOUBLE) * (CAST((o_orderkey * 7919) % 997 AS DOUBLE) "
    "/ CAST(996 AS DOUBLE))) - CAST(20000 AS DOUBLE) AS prediction",
)


@query(
    "intervals_by_model",
    f"""WITH p AS (SELECT *, greatest(prediction, 0.0) AS level, abs(actual - greatest(prediction, 0.0)) / greatest(abs(actual), 1.0) AS err
          FROM {derived_sql("orders", JUDGED)}),
        q AS (SELECT model, quantile_cont(level, [0.2, 0.4, 0.6, 0.8]) AS e, list_sort(list(err)) AS errs, count(*) AS n FROM p GROUP BY model),
        placed AS (SELECT p.*, len(list_filter(e, lambda x: x <= level)) AS segment FROM p JOIN q USING (model)),
        s AS (SELECT model, segment, list_sort(list(err)) AS errs, count(*) AS n FROM placed GROUP BY model, segment),
        w AS (SELECT s.model, s.segment, CASE WHEN s.n >= 10 THEN s.errs[CAST(ceil(CAST(0.95 AS DOUBLE) * (s.n - 1)) AS BIGINT) + 1]
          ELSE q.errs[CAST(ceil(CAST(0.95 AS DOUBLE) * (q.n - 1)) AS BIGINT) + 1] END AS width FROM s JOIN q USING (model))
        SELECT o_orderkey, placed.model, round(greatest(0.0, level * (1 - width)), 4) AS lower_bound, round(level * (1 + width), 4) AS upper_bound
        FROM placed JOIN w ON w.model = placed.model AND w.segment = placed.segment""",
)
def _(spark, sf):
    df = derived(spark, sf, "orders", JUDGED)
    bounded = keyed_intervals(df, ["model"], keyed_calibration(df, ["model"], "actual", "prediction"))
    return bounded.select("o_orderkey", "model", rounded("lower_bound", 4).alias("lower_bound"), rounded("upper_bound", 4).alias("upper_bound"))
