"""Quantiles, histograms, stability index and drift decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from evenkeel.catalog.registry import derived, derived_sql, query, rounded, table
from evenkeel.operators.drift import drift_check, drift_snapshot, should_retrain
from evenkeel.operators.histogram import histogram, psi, unique_edges_of, with_bin
from evenkeel.operators.sketches import day_sketches, load_sketches, save_sketches
from evenkeel.plans.monitoring import run_drift_check
from evenkeel.session import scratch_path
from evenkeel.sources.snapshots import load_snapshot, save_snapshot
from evenkeel.streaming.drift import compact_window_counts, psi_by_window, start_window_counts, window_drift

CUT = "1996-01-01"
PRICES = (
    "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL ELSE l_extendedprice END AS price",
    "l_quantity",
    "l_shipdate",
)
PRICES_SQL = derived_sql("lineitem", PRICES)
BEFORE = f"SELECT * FROM {PRICES_SQL} WHERE l_shipdate < TIMESTAMP '{CUT}'"
SINCE = f"SELECT * FROM {PRICES_SQL} WHERE l_shipdate >= TIMESTAMP '{CUT}'"


def prices(spark, sf) -> tuple[DataFrame, DataFrame]:
    df = derived(spark, sf, "lineitem", PRICES)
    return df.where(f"l_shipdate < TIMESTAMP_NTZ '{CUT}'"), df.where(f"l_shipdate >= TIMESTAMP_NTZ '{CUT}'")


def edges_sql(name: str, x: str, source: str, bins: int = 10) -> str:
    """CTE ``name``(i, edge): distinct interpolated quantiles of ``x``, numbered from 0."""
    steps = ", ".join(str(i / bins) for i in range(bins + 1))
    return f"""{name} AS (SELECT row_number() OVER (ORDER BY edge) - 1 AS i, edge FROM (
        SELECT DISTINCT unnest(quantile_cont(x, [{steps}])) AS edge FROM (SELECT {x} AS x FROM {source}) WHERE x IS NOT NULL))"""


def bins_sql(name: str, edges: str) -> str:
    """CTE ``name``(bin, low, high, last) from an edge CTE."""
    return f"""{name} AS (SELECT a.i + 1 AS bin, a.edge AS low, b.edge AS high,
        a.i + 1 = (SELECT max(i) FROM {edges}) AS last FROM {edges} a JOIN {edges} b ON b.i = a.i + 1)"""


def counts_sql(name: str, bins: str, x: str, source: str, clipped: bool) -> str:
    """CTE ``name``(bin, n): rows per bin, zero included."""
    value = x
    if clipped:
        value = f"least(greatest({x}, (SELECT min(low) FROM {bins})), (SELECT max(high) FROM {bins}))"
    return f"""{name} AS (SELECT b.bin, count(v.x) AS n FROM {bins} b LEFT JOIN
        (SELECT CASE WHEN {x} IS NULL THEN NULL ELSE {value} END AS x FROM {source}) v
        ON v.x >= b.low AND (v.x < b.high OR (b.last AND v.x <= b.high)) GROUP BY b.bin)"""


def psi_sql(ref: str, cur: str) -> str:
    """Index over two count CTEs with the same bins."""
    share = "CASE WHEN {0}.n = 0 THEN 1e-6 ELSE {0}.n / (SELECT CAST(sum(n) AS DOUBLE) FROM {0}) END"
    r, c = share.format(ref), share.format(cur)
    return f"SELECT sum(({r} - {c}) * ln(({r}) / ({c}))) AS psi FROM {ref} JOIN {cur} USING (bin)"


def full_psi_sql(x: str, ref: str, cur: str, clipped: bool = False) -> str:
    ctes = ", ".join(
        [
            edges_sql("edges", x, f"({ref})"),
            bins_sql("bins", "edges"),
            counts_sql("r", "bins", x, f"({ref})", False),
            counts_sql("c", "bins", x, f"({cur})", clipped),
            f"score AS ({psi_sql('r', 'c')})",
        ]
    )
    return f"WITH {ctes}"


# Two orders' prices are infinite, one way each.
UNBOUNDED = (
    "CASE WHEN l_orderkey = 1 THEN CAST('Infinity' AS DOUBLE) WHEN l_orderkey = 2 THEN CAST('-Infinity' AS DOUBLE) "
    "ELSE l_extendedprice END AS unbounded",
)
FINITE = "CASE WHEN edge = CAST('Infinity' AS DOUBLE) THEN 1e300 WHEN edge = CAST('-Infinity' AS DOUBLE) THEN -1e300 ELSE round(edge, 6) END"


@query(
    "quantile_edges",
    "WITH "
    + ", ".join(
        [
            edges_sql("a", "price", PRICES_SQL),
            edges_sql("b", "l_quantity", PRICES_SQL, 100),
            edges_sql("c", "unbounded", derived_sql("lineitem", UNBOUNDED)),
        ]
    )
    + f""" SELECT 'price' AS name, i, {FINITE} AS edge FROM a
          UNION ALL SELECT 'l_quantity', i, {FINITE} FROM b UNION ALL SELECT 'unbounded', i, {FINITE} FROM c""",
)
def _(spark, sf):
    df = derived(spark, sf, "lineitem", (*PRICES, *UNBOUNDED))
    columns = [("price", 10), ("l_quantity", 100), ("unbounded", 10)]
    found = unique_edges_of(df, columns)
    rows = [(name, i, edge) for (name, _), (_, edges) in zip(columns, found) for i, edge in enumerate(edges)]
    return spark.createDataFrame(rows, "name string, i bigint, edge double").withColumn("edge", F.expr(FINITE.replace("1e300", "1e300D")))


EXPLICIT = [10000.0, 25000.0, 50000.0, 50001.0, 50001.5, 90000.0]


@query(
    "histogram",
    "WITH edges AS (SELECT unnest(range(6)) AS i, unnest([10000.0, 25000.0, 50000.0, 50001.0, 50001.5, 90000.0]::DOUBLE[]) AS edge), "
    + bins_sql("bins", "edges")
    + ", "
    + counts_sql("c", "bins", "price", PRICES_SQL, False)
    + " SELECT CAST(bin AS INTEGER) AS bin, low, high, n AS count FROM c JOIN bins USING (bin)",
)
def _(spark, sf):
    return histogram(derived(spark, sf, "lineitem", PRICES), "price", EXPLICIT)


SIDE_ROWS = (
    f"(SELECT count(price) FROM ({BEFORE})) AS ref_rows, (SELECT count(price) FROM ({SINCE})) AS cur_rows"
)


@query("psi", full_psi_sql("price", BEFORE, SINCE) + f" SELECT round(psi, 9) AS psi, {SIDE_ROWS} FROM score")
def _(spark, sf):
    before, since = prices(spark, sf)
    return psi(before, since, "price").withColumn("psi", rounded("psi", 9))


@query("psi_log", full_psi_sql("ln(1 + price)", BEFORE, SINCE) + f" SELECT round(psi, 9) AS psi, {SIDE_ROWS} FROM score")
def _(spark, sf):
    before, since = prices(spark, sf)
    return psi(before, since, "price", log=True).withColumn("psi", rounded("psi", 9))


GUARDED = (
    "CAST(l_linenumber * 0 AS DOUBLE) AS constant",
    "CAST(l_quantity > 25 AS DOUBLE) AS two_edges",
    "l_quantity AS varied",
    "l_shipdate",
)
VARIED = (
    "SELECT l_quantity FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01'",
    "SELECT l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'",
)


@query(
    "psi_guards",
    full_psi_sql("l_quantity", *VARIED)
    + """ SELECT 'varied' AS name, round(psi, 9) AS psi FROM score
          UNION ALL SELECT 'constant', NULL UNION ALL SELECT 'two_edges', NULL UNION ALL SELECT 'few_rows', NULL""",
)
def _(spark, sf):
    df = derived(spark, sf, "lineitem", GUARDED)
    before, since = (df.where(f"l_shipdate {op} TIMESTAMP_NTZ '{CUT}'") for op in ("<", ">="))
    cases = [(c, psi(before, since, c)) for c in ("varied", "constant", "two_edges")]
    few, many = table(spark, sf, "region"), table(spark, sf, "nation")
    cases.append(("few_rows", psi(few, many, "r_regionkey", current_column="n_regionkey")))
    rows = [score.select(F.lit(name).alias("name"), rounded("psi", 9).alias("psi")) for name, score in cases]
    return reduce(DataFrame.unionAll, rows)


def snapshot_rows(spark, snap) -> DataFrame:
    values = [
        ("row_count", 0, float(snap.row_count)),
        ("bins", 0, float(snap.bins)),
        ("median", 0, snap.price_median),
        ("mean", 0, snap.price_mean),
        ("std", 0, snap.price_std),
        *[("edge", i, v) for i, v in enumerate(snap.price_log_bin_edges)],
        *[("share", i, v) for i, v in enumerate(snap.price_log_ref_pct)],
        *[("quantile", i, v) for i, v in enumerate(snap.price_raw_quantiles)],
    ]
    rows = [(snap.snapshot_date, *v) for v in values]
    df = spark.createDataFrame(rows, "snapshot_date string, field string, position bigint, value double")
    return df.withColumn("value", rounded("value"))


def snapshot_sql(source: str) -> str:
    steps = ", ".join(str(i / 10) for i in range(11))
    ctes = ", ".join(
        [
            edges_sql("edges", "ln(1 + price)", f"({source})"),
            bins_sql("bins", "edges"),
            counts_sql("r", "bins", "ln(1 + price)", f"({source})", False),
            f"src AS ({source})",
            f"qs AS (SELECT unnest(range(11)) AS i, unnest(quantile_cont(price, [{steps}])) AS v FROM src)",
            """v AS (SELECT 'row_count' AS field, 0 AS position, CAST(count(*) AS DOUBLE) AS value FROM src
               UNION ALL SELECT 'bins', 0, 10.0 UNION ALL SELECT 'median', 0, quantile_cont(price, 0.5) FROM src
               UNION ALL SELECT 'mean', 0, avg(price) FROM src UNION ALL SELECT 'std', 0, stddev_samp(price) FROM src
               UNION ALL SELECT 'edge', i, edge FROM edges
               UNION ALL SELECT 'share', bin - 1, n / (SELECT CAST(sum(n) AS DOUBLE) FROM r) FROM r
               UNION ALL SELECT 'quantile', i, v FROM qs)""",
        ]
    )
    return f"""WITH {ctes} SELECT (SELECT CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) FROM src) AS snapshot_date,
        field, position, round(value, 6) AS value FROM v"""


@query("drift_snapshot", snapshot_sql(f"SELECT * FROM {PRICES_SQL}"))
def _(spark, sf):
    return snapshot_rows(spark, drift_snapshot(derived(spark, sf, "lineitem", PRICES), "price", "l_shipdate"))


@query("drift_snapshot_merged", snapshot_sql(f"SELECT * FROM {PRICES_SQL}"))
def _(spark, sf):
    df = derived(spark, sf, "lineitem", PRICES)
    path, month = scratch_path(spark, "sketches"), F.date_format("l_shipdate", "yyyy-MM")
    # A year comes at a time, and the last one twice.
    for year in (*range(1992, 1999), 1998):
        save_sketches(day_sketches(df.where(F.year("l_shipdate") == year), F.col("price"), month), path)
    others = df.where("year(l_shipdate) < 1992 OR year(l_shipdate) > 1998")
    save_sketches(day_sketches(others, F.col("price"), month), path)
    return snapshot_rows(spark, drift_snapshot(df, "price", "l_shipdate", sketches=load_sketches(spark, path)))


@query("snapshot_roundtrip", snapshot_sql(f"SELECT * FROM {PRICES_SQL}"))
def _(spark, sf):
    path = scratch_path(spark, "snapshot")
    save_snapshot(spark, drift_snapshot(prices(spark, sf)[0], "price", "l_shipdate"), path)
    save_snapshot(spark, drift_snapshot(derived(spark, sf, "lineitem", PRICES), "price", "l_shipdate"), path)
    return snapshot_rows(spark, load_snapshot(spark, path))


LEVEL = "CASE WHEN psi IS NULL THEN 'unknown' WHEN psi >= 0.02 THEN 'high' WHEN psi >= 0.01 THEN 'moderate' ELSE 'none' END"


def drift_check_sql() -> str:
    day = "CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR)"
    return (
        full_psi_sql("ln(1 + price)", BEFORE, SINCE, clipped=True)
        + f""", lev AS (SELECT psi, {LEVEL} AS level FROM score)
        SELECT psi >= 0.01 AS should_retrain, round(psi, 9) AS psi, CAST(0.01 AS DOUBLE) AS psi_threshold,
          level AS drift_level,
          (SELECT count(*) FROM ({SINCE})) AS current_row_count, (SELECT count(*) FROM ({BEFORE})) AS reference_row_count,
          (SELECT round(quantile_cont(price, 0.5), 6) FROM ({SINCE})) AS current_price_median,
          (SELECT round(quantile_cont(price, 0.5), 6) FROM ({BEFORE})) AS reference_price_median,
          (SELECT {day} FROM ({BEFORE})) AS reference_snapshot_date, (SELECT {day} FROM ({SINCE})) AS current_snapshot_date,
          CASE WHEN level = 'none' THEN 'No significant drift (PSI=' || printf('%.4f', psi) || '). Retraining skipped.'
               ELSE upper(left(level, 1)) || substr(level, 2) || ' drift (PSI=' || printf('%.4f', psi)
                    || '). Retraining triggered (threshold=0.01).' END AS reason
        FROM lev"""
    )


def flagship(spark, sf) -> DataFrame:
    before, since = prices(spark, sf)
    result = drift_check(since, "price", "l_shipdate", drift_snapshot(before, "price", "l_shipdate"))
    return result.withColumns(
        {
            "psi": rounded("psi", 9),
            "current_price_median": rounded("current_price_median"),
            "reference_price_median": rounded("reference_price_median"),
        }
    )


query("drift_check", drift_check_sql())(flagship)


@query(
    "drift_first_run",
    f"""SELECT false AS should_retrain, CAST(NULL AS DOUBLE) AS psi, 'no_reference' AS drift_level,
        count(*) AS current_row_count, round(quantile_cont(price, 0.5), 6) AS current_price_median,
        CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS current_snapshot_date FROM {PRICES_SQL}""",
)
def _(spark, sf):
    path = scratch_path(spark, "first")
    first = run_drift_check(derived(spark, sf, "lineitem", PRICES), path, "price", "l_shipdate")
    return first.select(
        "should_retrain",
        "psi",
        "drift_level",
        "current_row_count",
        rounded("current_price_median").alias("current_price_median"),
        "current_snapshot_date",
    )


EVENT_VALUES = ("ts", "value")
EVENT_FILES = 8
DAILY = (
    "WITH "
    + ", ".join(
        [
            edges_sql("edges", "ln(1 + value)", "events"),
            bins_sql("bins", "edges"),
            counts_sql("r", "bins", "ln(1 + value)", "events", False),
            "tot AS (SELECT CAST(sum(n) AS DOUBLE) AS t FROM r)",
            """cells AS (SELECT date_trunc('day', e.ts) AS d, b.bin, count(*) AS n FROM events e JOIN bins b
               ON ln(1 + e.value) >= b.low AND (ln(1 + e.value) < b.high OR (b.last AND ln(1 + e.value) <= b.high))
               GROUP BY 1, 2)""",
            "days AS (SELECT d, sum(n) AS rows FROM cells GROUP BY d)",
            """full_cells AS (SELECT days.d, days.rows, r.bin,
                 CASE WHEN r.n = 0 THEN 1e-6 ELSE r.n / tot.t END AS rs,
                 CASE WHEN coalesce(cells.n, 0) = 0 THEN 1e-6 ELSE cells.n / CAST(days.rows AS DOUBLE) END AS cs
               FROM days CROSS JOIN r CROSS JOIN tot LEFT JOIN cells ON cells.d = days.d AND cells.bin = r.bin)""",
            "per_day AS (SELECT d, CAST(max(rows) AS BIGINT) AS rows, sum((rs - cs) * ln(rs / cs)) AS psi FROM full_cells GROUP BY d)",
        ]
    )
)


def by_day(df: DataFrame) -> DataFrame:
    return df.select(
        F.date_format("start", "yyyy-MM-dd").alias("day"), "rows", rounded("psi", 9).alias("psi"), "drift_level"
    )


@query(
    "drift_level",
    DAILY
    + f""" SELECT strftime(d, '%Y-%m-%d') AS day, rows, round(psi, 9) AS psi, {LEVEL} AS drift_level,
        psi >= 0.01 AND psi >= 0.015 AS should_retrain FROM per_day""",
)
def _(spark, sf):
    events = derived(spark, sf, "events", EVENT_VALUES)
    snap = drift_snapshot(events, "value", "ts")
    binned = with_bin(events, F.log1p("value"), snap.price_log_bin_edges, clipped=True)
    counts = binned.groupBy(F.date_trunc("day", "ts").alias("start"), "bin").agg(F.count("*").alias("n"))
    daily = by_day(psi_by_window(counts, snap))
    return daily.withColumn("should_retrain", should_retrain(F.col("psi"), 0.015))


@query(
    "stream_drift",
    DAILY + f" SELECT strftime(d, '%Y-%m-%d') AS day, rows, round(psi, 9) AS psi, {LEVEL} AS drift_level FROM per_day",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    snap = drift_snapshot(events, "value", "ts")
    # The events as files of some days each, written and hence read newest first, one per batch. The first half is
    # counted and compacted, then a stream that knows nothing of it (a new checkpoint) counts the other half.
    target = scratch_path(spark, "windows")
    newest, oldest = events.select(F.max(F.to_date("ts")), F.min(F.to_date("ts"))).first()
    days = (newest - oldest).days + 1
    age = F.floor(F.datediff(F.lit(newest), F.to_date("ts")) * EVENT_FILES / days)
    for half in range(2):
        source, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "windows-checkpoint")
        for k in range(half * EVENT_FILES // 2, (half + 1) * EVENT_FILES // 2):
            events.where(age == k).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
        start_window_counts(stream, "ts", "value", snap, target, checkpoint).awaitTermination()
        compact_window_counts(spark, target)
    return by_day(window_drift(spark, target, snap))
