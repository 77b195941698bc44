"""Sources, sinks, cleaning, validation and lookups."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F

from evenkeel.catalog.registry import ORDER_DAY, PRICED, derived, derived_sql, query, rounded, table
from evenkeel.contract import Contract
from evenkeel.functions.numeric import clip
from evenkeel.functions.text import mask_middle, title_label
from evenkeel.operators.clean import (
    cast_numeric,
    dedupe_full_row,
    drop_if_present,
    exclude_categories,
    latest_per_key,
    outlier_filter,
    select_contract,
)
from evenkeel.operators.maintained import LatestTable
from evenkeel.operators.drift import max_date
from evenkeel.operators.enrich import dim_backfill
from evenkeel.operators.validate import (
    FORM_RULES,
    REQUEST_RULES,
    Rule,
    alias_rename,
    located_rules,
    optional_defaults,
    validate_rows,
)
from evenkeel.session import scratch_path
from evenkeel.sources.tables import read_csv, scan_not_null, scan_positive, sql_query, write_counted, write_csv

PRICED_SQL = derived_sql("orders", PRICED)


@query("scan_not_null", f"SELECT * FROM {PRICED_SQL} WHERE price IS NOT NULL")
def _(spark, sf):
    return scan_not_null(derived(spark, sf, "orders", PRICED), "price")


@query("scan_positive", "SELECT * FROM customer WHERE c_acctbal IS NOT NULL AND c_acctbal > 0")
def _(spark, sf):
    return scan_positive(table(spark, sf, "customer"), "c_acctbal")


@query(
    "sql_named_params",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'",
)
def _(spark, sf):
    return sql_query(
        spark,
        "SELECT o_orderkey, o_totalprice FROM priced_orders WHERE o_totalprice > :low AND o_orderstatus = :status",
        {"priced_orders": table(spark, sf, "orders")},
        low=250000,
        status="F",
    )


# Whole texts with their quotes and line breaks, and cells with spaces around.
PROSE = ("doc_id", "text", "concat('  ', lang, ' ') AS padded", "concat('\"', source, '\", \"\"') AS quoted", "n_chars")


@query("csv_roundtrip", f"SELECT * FROM {derived_sql('documents', PROSE)}")
def _(spark, sf):
    df = derived(spark, sf, "documents", PROSE)
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


@query("csv_inferred", f"SELECT * FROM {PRICED_SQL}")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(derived(spark, sf, "orders", PRICED), path)
    return read_csv(spark, path, multiline=False)


@query("ingest_count", "SELECT count(*) AS rows FROM lineitem")
def _(spark, sf):
    seen = Observation()
    write_counted(table(spark, sf, "lineitem"), scratch_path(spark, "ingest"), seen)
    return spark.createDataFrame([(seen.get["rows"],)], "rows bigint")


@query("drop_if_present", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    return drop_if_present(table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority", "not_there"])


PARTS = Contract(numeric=("p_size",), categorical=("p_type", "p_brand"), target="p_retailprice")


@query("select_contract", "SELECT p_size, p_type, p_brand, p_retailprice FROM part")
def _(spark, sf):
    return select_contract(table(spark, sf, "part"), PARTS)


KINDS = ("p_partkey", "CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS kind", "p_retailprice")


@query(
    "exclude_categories",
    f"SELECT * FROM {derived_sql('part', KINDS)} WHERE kind IS NULL OR kind NOT IN ('SMALL', 'LARGE')",
)
def _(spark, sf):
    return exclude_categories(derived(spark, sf, "part", KINDS), "kind", ["SMALL", "LARGE"])


@query(
    "cast_numeric",
    "SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS DOUBLE) AS price FROM part",
)
def _(spark, sf):
    text = ("p_partkey", "CAST(p_size AS STRING) AS size", "CAST(p_retailprice AS DECIMAL(12, 2)) AS price")
    return cast_numeric(derived(spark, sf, "part", text), ["size", "price"])


LOTS = (
    "l_orderkey",
    "l_linenumber",
    "CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS price",
    "CASE WHEN l_linestatus = 'F' AND l_tax = 0 THEN NULL ELSE l_quantity END AS area",
)


@query(
    "outlier_filter",
    f"SELECT * FROM {derived_sql('lineitem', LOTS)} WHERE price >= 5000 AND price <= 90000 AND area >= 5",
)
def _(spark, sf):
    return outlier_filter(derived(spark, sf, "lineitem", LOTS), "price", "area", 5000.0, 90000.0, 5.0)


@query(
    "dedupe_full_row",
    f"SELECT DISTINCT * FROM (SELECT * FROM {PRICED_SQL} UNION ALL SELECT * FROM {PRICED_SQL})",
)
def _(spark, sf):
    df = derived(spark, sf, "orders", PRICED)
    return dedupe_full_row(df.unionAll(df))


DATED = ("o_custkey", "o_orderkey", "o_totalprice", ORDER_DAY)


@query(
    "latest_per_key",
    f"""SELECT o_custkey, o_orderkey, o_totalprice, day FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey DESC) AS k
        FROM {derived_sql("orders", DATED)}) WHERE k = 1""",
)
def _(spark, sf):
    return latest_per_key(derived(spark, sf, "orders", DATED), "o_custkey", "day", ["o_orderkey"])


MAINTAINED_KEY = ("o_custkey",)


@query(
    "latest_maintained",
    f"""SELECT o_custkey, o_orderkey, o_totalprice, day FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey DESC) AS k
        FROM {derived_sql("orders", DATED)}) WHERE k = 1""",
)
def _(spark, sf):
    df = derived(spark, sf, "orders", DATED)
    kept = LatestTable(spark, scratch_path(spark, "latest"), df.schema, MAINTAINED_KEY, "day", ("o_orderkey",), buckets=16)
    # Three extracts, the middle one of the days first: rows of the last come late.
    for third in (1, 2, 0):
        kept.merge(df.where(F.pmod(F.crc32(F.col("day").cast("binary")), F.lit(3)) == third))
    return kept.rows()


OLD_NAMES = (
    "o_orderkey",
    "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 5 = 1 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END AS living_area",
    "o_totalprice + 1 AS livingarea",
    "o_orderpriority AS propertytype",
)


@query(
    "alias_rename",
    f"""SELECT o_orderkey, coalesce(CASE WHEN NOT isnan(living_area) THEN living_area END, livingarea) AS living_area, propertytype AS property_type
        FROM {derived_sql("orders", OLD_NAMES)}""",
)
def _(spark, sf):
    df = derived(spark, sf, "orders", OLD_NAMES)
    return alias_rename(df, {"livingarea": "living_area", "propertytype": "property_type"})


@query(
    "optional_defaults",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(price, 5000.0) AS price, day, 5000.0::DOUBLE AS lot
        FROM {PRICED_SQL}""",
)
def _(spark, sf):
    return optional_defaults(derived(spark, sf, "orders", PRICED), {"price": 5000.0, "lot": 5000.0})


# Line items read as scoring requests, a good part of them out of range or incomplete.
REQUESTS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "CASE WHEN l_orderkey % 9 = 4 THEN 'many' WHEN l_orderkey % 9 = 5 THEN 'NaN' ELSE CAST(l_linenumber * 4 - 5 AS STRING) END AS bedrooms",
    "CASE WHEN l_linestatus = 'O' AND l_tax = 0 THEN NULL ELSE l_quantity - 10 END AS bathrooms",
    "CASE WHEN l_orderkey % 7 = 3 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice / 5 - 300 END AS living_area",
    "CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_discount * 1000 END AS latitude",
    "l_tax * 20 - CAST(115.8 AS DOUBLE) AS longitude",
    "CASE WHEN l_returnflag = 'R' THEN '' ELSE l_linestatus END AS property_type",
)
REQUEST_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


# Columns of the requests that hold text in place of numbers.
TEXT_NUMBERS = ("bedrooms",)


def rules_sql(rules, source: str, key: tuple[str, ...]) -> str:
    """The same checks spelled as SQL conditions."""
    checks = []
    for r in rules:
        numeric = any(x is not None for x in (r.low, r.high, r.above))
        c, missing, wrong = r.column, f"{r.column} IS NULL OR CAST({r.column} AS VARCHAR) IN ('', 'nan', 'NaN')", "false"
        if numeric:
            value = f"TRY_CAST({c} AS DOUBLE)"
            wrong = f"{value} IS NULL AND {c} IS NOT NULL AND CAST({c} AS VARCHAR) <> ''"
            c = f"(CASE WHEN NOT isnan({value}) THEN {value} END)"
        conditions = []
        if r.required:
            conditions.append((missing, f"{r.column}: missing"))
        if numeric and r.column in TEXT_NUMBERS:
            conditions.append((wrong, f"{r.column}: Must be a number"))
        if r.low is not None:
            conditions.append((f"{c} < {r.low}", f"{r.column}: Must be >= {r.low}"))
        if r.above is not None:
            conditions.append((f"{c} <= {r.above}", f"{r.column}: Must be > {r.above}"))
        if r.high is not None:
            conditions.append((f"{c} > {r.high}", f"{r.column}: Must be <= {r.high}"))
        if r.whole:
            conditions.append((f"{c} <> floor({c})", f"{r.column}: Must be a whole number"))
        if r.domain is not None:
            listed = ", ".join(f"'{v}'" for v in r.domain)
            conditions.append((f"{c} NOT IN ({listed})", f"{r.column}: Unknown value"))
        checks += [f"CASE WHEN {cond} THEN '{message}' END" for cond, message in conditions]
    joined = f"concat_ws('; ', {', '.join(checks)})"
    return f"SELECT {', '.join(key)}, {joined} AS errors, {joined} = '' AS valid FROM {source}"


def checked(df, rules, key):
    return validate_rows(df, rules).select(*key, F.concat_ws("; ", "errors").alias("errors"), "valid")


@query("row_validation", rules_sql((*REQUEST_RULES, *located_rules()), derived_sql("lineitem", REQUESTS), REQUEST_KEY))
def _(spark, sf):
    return checked(derived(spark, sf, "lineitem", REQUESTS), (*REQUEST_RULES, *located_rules()), REQUEST_KEY)


@query("row_validation_strict", rules_sql(FORM_RULES, derived_sql("lineitem", REQUESTS), REQUEST_KEY))
def _(spark, sf):
    return checked(derived(spark, sf, "lineitem", REQUESTS), FORM_RULES, REQUEST_KEY)


DOMAINS = (Rule("kind", domain=("SMALL", "LARGE", "MEDIUM")),)


@query("domain_check", rules_sql(DOMAINS, derived_sql("part", KINDS), ("p_partkey",)))
def _(spark, sf):
    return checked(derived(spark, sf, "part", KINDS), DOMAINS, ("p_partkey",))


PLACES = (
    "c_custkey",
    "c_nationkey",
    "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal END AS latitude",
    "CASE WHEN c_acctbal < 2000 THEN NULL ELSE c_acctbal END AS longitude",
)
CENTRES = ("n_nationkey AS c_nationkey", "n_nationkey * 1.5 AS dim_lat", "n_nationkey * -2.0 AS dim_lon", "n_regionkey")


@query(
    "dim_backfill",
    f"""SELECT c_custkey, c_nationkey, coalesce(latitude, CAST(dim_lat AS DOUBLE)) AS latitude,
               coalesce(longitude, CAST(dim_lon AS DOUBLE)) AS longitude
        FROM {derived_sql("customer", PLACES)} LEFT JOIN
             (SELECT * FROM {derived_sql("nation", CENTRES)} WHERE n_regionkey > 0) USING (c_nationkey)""",
)
def _(spark, sf):
    dim = derived(spark, sf, "nation", CENTRES).where("n_regionkey > 0")
    fills = {"latitude": "dim_lat", "longitude": "dim_lon"}
    return dim_backfill(derived(spark, sf, "customer", PLACES), dim, "c_nationkey", fills)


@query(
    "log_roundtrip",
    """SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS logged,
              round(exp(ln(1 + o_totalprice)) - 1, 4) AS back FROM orders""",
)
def _(spark, sf):
    logged = F.log1p("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", rounded(logged).alias("logged"), rounded(F.expm1(logged), 4).alias("back")
    )


@query(
    "clip",
    f"""SELECT o_orderkey, CASE WHEN price IS NULL THEN NULL ELSE least(greatest(price, 50000), 300000) END AS clipped
        FROM {PRICED_SQL}""",
)
def _(spark, sf):
    df = derived(spark, sf, "orders", PRICED)
    return df.select("o_orderkey", clip(F.col("price"), 50000.0, 300000.0).alias("clipped"))


@query("max_date", "SELECT CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS newest FROM orders")
def _(spark, sf):
    df = table(spark, sf, "orders")
    return df.agg(max_date(df, "o_orderdate").alias("newest"))


@query(
    "mask_string",
    """SELECT c_custkey, CASE WHEN length(name) > 4 THEN left(name, 2) || '***' || right(name, 2)
              WHEN length(name) > 0 THEN repeat('*', length(name)) END AS masked, name
       FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS name FROM customer)""",
)
def _(spark, sf):
    named = ("c_custkey", "CASE WHEN c_acctbal < 0 THEN CAST(c_custkey AS STRING) ELSE c_name END AS name")
    return derived(spark, sf, "customer", named).select("c_custkey", mask_middle(F.col("name")).alias("masked"), "name")


@query(
    "title_label",
    """SELECT p_partkey, array_to_string(list_transform(string_split(replace(label, '_', ' '), ' '),
              lambda w: upper(w[1]) || lower(w[2:])), ' ') AS label
       FROM (SELECT p_partkey, replace(p_name, ' ', '_') AS label FROM part)""",
)
def _(spark, sf):
    df = derived(spark, sf, "part", ("p_partkey", "replace(p_name, ' ', '_') AS label"))
    return df.select("p_partkey", title_label(F.col("label")).alias("label"))
