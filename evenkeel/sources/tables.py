"""Table readers: JDBC, parquet, SQL text, CSV."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from evenkeel.session import materialize
from evenkeel.sources.records import csv_cells

# The texts that count as missing in a CSV cell.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    partitions: int,
    bounds: tuple[int, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Remote table in parallel range slices; row filters on the result reach the database.

    The slices cover the partition column's lowest to highest value, which the database is asked for unless
    ``bounds`` gives them. Rows beyond bounds are in the outer slices, so wrong bounds cost balance and no row.
    """
    options = dict(properties or {})
    if bounds is None:
        ends = f"(SELECT min({partition_column}) AS low, max({partition_column}) AS high FROM {table}) ends"
        row = spark.read.jdbc(url, ends, properties=options).first()
        bounds = (row[0] or 0, row[1] or 0)
    low, high = bounds
    if low == high:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=low, upperBound=high, numPartitions=partitions, properties=options
    )


def scan_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows with a value in ``column``; the predicate is pushed to the scan."""
    return df.where(F.col(column).isNotNull())


def scan_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows with ``column`` above zero. NaN, which Spark orders above every number, fails."""
    return df.where((F.col(column) > 0) & ~F.isnan(column))


def sql_query(spark: SparkSession, query: str, views: Mapping[str, DataFrame], **params: Any) -> DataFrame:
    """Run SQL text with ``:name`` markers over the given views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=params)


def _present(name: str) -> Column:
    """A CSV cell, NULL where its text counts as missing."""
    c = F.col(f"`{name}`")
    return F.when(~c.isin(*CSV_MISSING), c)


# What a text must look like for a cast to double to be tried: a try that fails makes an exception, for each cell.
NUMBER = r"\A[\x00-\x20]*[0-9A-FXPINTYa-fxpinty+.\-]+[\x00-\x20]*\z"

# Likewise for bigint: digits, signs and what the cast trims.
WHOLE_NUMBER = r"\A[0-9+\-\x00-\x20\x7F]*\z"


KINDS = {"bigint": WHOLE_NUMBER, "double": NUMBER}

# Records in a written file: what a task reads in some seconds.
FILE_RECORDS = 1_000_000

# Rows that are looked at first: a type that one of their cells does not fit needs no look at the others.
FIRST_LOOK = 1000

# Columns in a pass of type inference. More at once make code of a size that the JVM only interprets.
AT_ONCE = 8


def _fitting(raw: DataFrame, asked: Mapping[str, str]) -> dict[str, tuple[int, int]]:
    """Per column its present cells and how many of them can be read as the type that is asked of it."""
    found = {}
    for i in range(0, len(asked), AT_ONCE):
        part = dict(list(asked.items())[i : i + AT_ONCE])
        texts = raw.select(*[_present(name).alias(name) for name in part])
        counts = []
        for name, kind in part.items():
            c = F.col(f"`{name}`")
            counts += [F.count(c), F.count(F.when(c.rlike(KINDS[kind]), c).try_cast(kind))]
        row = texts.agg(*counts).first()
        found |= {name: (row[2 * k], row[2 * k + 1]) for k, name in enumerate(part)}
    return found


def inferred_types(raw: DataFrame) -> dict[str, str]:
    """bigint, double or string per text column: the narrowest that all its present cells can be read as.

    The first rows rule out most types that don't fit; each pass then tries the narrowest type left of a column on all its cells, so
    there are two at most. A column without a present cell is double.
    """
    left = {name: list(KINDS) for name in raw.columns}
    kinds = {}
    first = raw.limit(FIRST_LOOK)
    for kind in KINDS:
        for name, (n, fit) in _fitting(first, dict.fromkeys(raw.columns, kind)).items():
            if fit < n:
                left[name].remove(kind)
    while open := [name for name in raw.columns if name not in kinds]:
        kinds |= {name: "string" for name in open if not left[name]}
        for name, (n, fit) in _fitting(raw, {name: left[name][0] for name in open if left[name]}).items():
            if fit == n:
                kinds[name] = left[name][0] if n else "double"
            else:
                left[name].pop(0)
    return {name: kinds[name] for name in raw.columns}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = True, whole_files: bool = False
) -> DataFrame:
    """CSV with a header; quotes in cells are doubled, cells may hold line breaks.

    Cells are read as text, missing texts become NULL, and the rest is cast under ANSI rules: to
    the schema's types, or without a schema to what ``inferred_types`` finds in the cells, which
    are stored for that. A line with too few or too many cells is an error, and so is a header other than the schema's.
    Large files are read in byte ranges by many tasks (``records``). Files whose cells hold no line break can be
    read with ``multiline=False``; ``whole_files`` leaves records to Spark's parser, a file in a task, for files with quotes
    within unquoted cells.
    """
    options = {
        "header": True, "quote": '"', "escape": '"', "multiLine": multiline, "mode": "FAILFAST", "columnPruning": False,
    }
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if multiline and not whole_files:
        raw, names = csv_cells(spark, path, store=wanted is None)
        if wanted is not None and names != wanted.names:
            raise ValueError(f"the header has {names}, the schema {wanted.names}")
    elif wanted is None:
        raw = spark.read.csv(path, **{k: v for k, v in options.items() if k != "columnPruning"})
        raw = spark.read.schema(raw.schema).options(**options).csv(path)
        # Inference takes a pass for so many columns.
        raw = materialize(raw, "csv-cells") if len(raw.columns) > AT_ONCE else raw
    else:
        text = StructType()
        for f in wanted.fields:
            text = text.add(f.name, "string")
        raw = spark.read.schema(text).options(enforceSchema=False, **options).csv(path)
    kinds = inferred_types(raw) if wanted is None else {f.name: f.dataType for f in wanted.fields}
    return raw.select(*[_present(name).cast(kind).alias(name) for name, kind in kinds.items()])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, no index column; quotes doubled, spaces around a cell kept. Files have ``FILE_RECORDS`` records at most."""
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    options["maxRecordsPerFile"] = FILE_RECORDS
    df.write.mode(mode).options(header=True, **options).csv(path)


def write_counted(df: DataFrame, path: str, observation: Observation, mode: str = "overwrite") -> None:
    """Write parquet and count the rows on the way: ``observation.get["rows"]`` afterwards."""
    df.observe(observation, F.count("*").alias("rows")).write.mode(mode).parquet(path)


