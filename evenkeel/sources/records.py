"""CSV cells of large files, cells with line breaks included, found by many tasks at once.

A file is read in byte ranges as lines. A line begins a record if an even number of quotes stands
before it in the file: every range counts its quotes, the counts are summed over the ranges before
it, and within a range over the lines before it, in the task that reads them. There lines are put together to
records without a shuffle, and records are cut into cells a batch at a time. Only what a range's ends cut off meets what other
ranges have of it; such records, and those that are not plain CSV, are left to Spark's parser, a record at a time. This holds where
quotes stand around cells and are doubled within them, as ``write_csv`` and its like write them; a file with an odd number of quotes
is an error.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from evenkeel.session import materialize

QUOTE = '"'


# Files up to this size are a task's work as a whole.
WHOLE_FILE = 256 << 20


def csv_cells(spark: SparkSession, path: str, store: bool = False) -> tuple[DataFrame, list[str]]:
    """The cells of all records of the files under ``path`` as text, a column per name of their header, and these names.

    A record with too few or too many cells is an error. Files of up to ``WHOLE_FILE`` bytes are left to Spark's parser, a file in a
    task, if their lines end in line feeds alone; all others are read in byte ranges. ``store``: the cells are written, for several
    passes.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.col("_metadata.file_size").alias("size"),
    )
    one = lines.select("value").first()
    if one is None:
        raise ValueError("no header")
    header = one["value"]
    value = F.col("value")
    quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit(QUOTE), F.lit("")))
    # A row per byte range.
    counted = lines.groupBy("file", "range").agg(
        F.sum(quotes).alias("quotes"),
        F.count_if(value == header).alias("headers"),
        F.count_if(value.contains("\r") | value.contains("\0")).alias("odd"),
        F.max("size").alias("size"),
    )
    counted = materialize(counted.withColumn("id", F.monotonically_increasing_id()), "csv-ranges")
    files = counted.groupBy("file").agg(*[F.sum(c).alias(c) for c in ("quotes", "headers", "odd")], F.max("size").alias("size"))
    broken = files.where("quotes % 2 != 0").select("file").first()
    if broken:
        raise ValueError(f"{broken['file']} has a quote that isn't closed")
    names = header.split(",")
    if header and QUOTE not in header and len({name.lower() for name in names}) == len(names) and "" not in names:
        odd, size, headers = files.agg(F.max("odd"), F.max("size"), F.min("headers")).first()
        if not odd and size <= WHOLE_FILE and headers:
            text = StructType([StructField(name, StringType()) for name in names])
            options = {"header": True, "enforceSchema": False, "quote": QUOTE, "escape": QUOTE, "multiLine": True}
            options |= {"mode": "FAILFAST", "columnPruning": False}
            read = spark.read.schema(text).options(**options).csv(path)
            return (materialize(read, "csv-cells") if store else read), names
    return _ranges(spark, path, lines, counted, store)


def _ranges(spark: SparkSession, path: str, lines: DataFrame, counted: DataFrame, store: bool) -> tuple[DataFrame, list[str]]:
    """``csv_cells`` for files that many tasks read; ``counted`` has the quotes of each byte range.

    The cells of plain CSV are always stored.
    """
    earlier = Window.partitionBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(earlier.orderBy("range")), F.lit(0))
    ranges = counted.select("file", "range", "id", (before % 2 != 0).alias("inside"))
    # The broadcast leaves a range's lines in their task and in their order.
    placed = lines.join(F.broadcast(ranges), ["file", "range"]).select("id", "inside", (F.col("range") == 0).alias("start"), "value")

    def stored(width: int) -> tuple[DataFrame, DataFrame]:
        """The pieces of all ranges and the records among them that are left as text."""
        kinds = "".join(f", c{i} string" for i in range(width))
        pieces = placed.mapInArrow(_pieces(width), f"id bigint, first boolean, piece int, record string{kinds}")
        pieces = materialize(pieces, "csv-records")
        return pieces, _texts(pieces, ranges.select("file", "range", "id"))

    # Of one file only the first record is looked at.
    width = len(spark.read.csv(path, quote=QUOTE, escape=QUOTE, multiLine=True).columns)
    pieces, texts = stored(width)
    names = header_of(texts)
    if len(names) != width:
        width = 0
        pieces, texts = stored(width)
    plain = pieces.where(F.col("piece") == CELLS)
    plain = plain.select(*[(F.col(f"c{i}") if width else F.lit("")).alias(name) for i, name in enumerate(names)])
    others = cells(texts, names)
    return plain.union(materialize(others, "csv-cells") if store else others), names


def _texts(pieces: DataFrame, known: DataFrame) -> DataFrame:
    """(file, first, record): every record that isn't in cells yet as text; ``first`` marks a file's header."""
    known = F.broadcast(known)
    whole = pieces.where(F.col("piece") == WHOLE).join(known, "id").select("file", "first", "record")
    # At most a few pieces per range from here on.
    cut = pieces.where(F.col("piece").isin(REST, LAST)).join(known, "id")
    earlier = Window.partitionBy("file").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.when(F.col("piece") == LAST, F.col("range")), ignorenulls=True).over(earlier.orderBy("range", "piece"))
    number = F.when(F.col("piece") == LAST, F.col("range")).otherwise(opened)
    joined = cut.withColumn("number", number).groupBy("file", "number").agg(
        F.bool_or("first").alias("first"), F.array_sort(F.collect_list(F.struct("range", "piece", "record"))).alias("lines")
    )
    records = whole.unionByName(joined.select("file", "first", F.array_join("lines.record", "\n").alias("record")))
    ended = records.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return ended.where(F.col("first") | (F.col("record") != ""))


# A record that a byte range holds whole, the lines up to a range's first end of a record that began before it (all lines, if
# none ends), those of a record that it leaves open, and a whole record in cells.
WHOLE, REST, LAST, CELLS = 0, 1, 2, 3

# Cells without a quote, or in quotes with all others doubled: Arrow's parser and Spark's agree on these.
_CELL = r'(?:[^",\r\n\x00]*|"(?:[^"\x00]|"")*")'
PLAIN = rf"\A{_CELL}(?:,{_CELL})*\r?\z"


def _pieces(width: int):
    """A function for ``mapInArrow``: a range's lines (id, inside, start, value), in their order, put together to records.

    Whole records but a file's first are cut into ``width`` cells; those that are not plain, and batches in which a record has
    another number of cells, stay text.
    """
    whole, rest, last, done, quote, plain = WHOLE, REST, LAST, CELLS, QUOTE, PLAIN

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.csv

        names = [f"c{i}" for i in range(width)]
        kept = pa.csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), null_values=[])

        def out(id, flags, kinds, records, cut=()):
            n = len(kinds)
            columns = [pa.array(np.full(n, id)), pa.array(flags, pa.bool_()), pa.array(kinds, pa.int32()), records]
            columns += cut or [pa.nulls(n, pa.string()) for _ in names]
            return pa.RecordBatch.from_arrays(columns, ["id", "first", "piece", "record", *names])

        def in_cells(id, records):
            """The records as cells where they can be, else as text."""
            fits = pc.match_substring_regex(records, plain) if width else pa.array(np.zeros(len(records), bool))
            some = records.filter(fits)
            text = together(some, [0, len(some)]).cast(pa.binary())[0].as_buffer() if len(some) else b""
            try:
                # Spark keeps a mark of byte order, Arrow drops it.
                if len(text) == 0 or text[:3].to_pybytes() == b"\xef\xbb\xbf":
                    raise pa.ArrowInvalid("left to Spark")
                read = pa.csv.ReadOptions(use_threads=False, block_size=len(text) + 1, column_names=names)
                found = pa.csv.read_csv(pa.BufferReader(text), read, pa.csv.ParseOptions(newlines_in_values=True), kept).combine_chunks()
            except pa.ArrowInvalid:
                yield out(id, np.zeros(len(records), bool), np.full(len(records), whole), records)
                return
            n = found.num_rows
            cut = [c.chunk(0) if c.num_chunks else pa.array([], pa.string()) for c in found.columns]
            yield out(id, np.zeros(n, bool), np.full(n, done), pa.nulls(n, pa.string()), cut)
            others = records.filter(pc.invert(fits))
            if len(others):
                yield out(id, np.zeros(len(others), bool), np.full(len(others), whole), others)

        def together(lines, starts):
            """The lines from each start to the next as one text."""
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines.cast(pa.string())), "\n")

        def left(held):
            """What a range leaves open when it ends, or the whole of it if no record ends there."""
            if held and held["open"]:
                text = "\n".join(t for part in held["open"] for t in part.to_pylist())
                kind = last if held["began"] else rest
                yield out(held["id"], [held["fresh"]], [kind], pa.array([text], pa.string()))

        held = None
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)] if len(ids) else []
            for a, b in zip(edges, edges[1:]):
                if held is None or held["id"] != ids[a]:
                    yield from left(held)
                    inside = batch.column(1)[a].as_py()
                    # ``began``: the open lines are a record's beginning; ``fresh``: they are the file's first record.
                    held = {"id": ids[a], "inside": inside, "open": [], "began": not inside, "fresh": batch.column(2)[a].as_py()}
                lines = batch.column(3).slice(a, b - a)
                odd = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False) % 2
                within = (np.cumsum(odd) + held["inside"]) % 2 == 1  # after each line
                held["inside"] = bool(within[-1])
                ends = np.flatnonzero(~within) + 1  # a record ends before each of these
                if len(ends):
                    if held["open"]:
                        lines, pad = pa.concat_arrays([*held["open"], lines]), sum(len(o) for o in held["open"])
                        ends = ends + pad
                    records = together(lines.slice(0, int(ends[-1])), [0, *ends.tolist()])
                    if held["fresh"] or not held["began"]:
                        yield out(held["id"], [held["fresh"]], [whole if held["began"] else rest], records.slice(0, 1))
                        records = records.slice(1)
                    if len(records):
                        yield from in_cells(held["id"], records)
                    held |= {"open": [], "began": True, "fresh": False}
                    lines = lines.slice(int(ends[-1]))
                if len(lines):
                    held["open"].append(lines)
        yield from left(held)

    return run


def header_of(records: DataFrame) -> list[str]:
    """The column names; files that differ in them are an error."""
    found = [r["record"] for r in records.where("first").select("record").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError("no header" if not found else f"files with different headers: {found}")
    return next(csv.reader([found[0]], doublequote=True))


def cells(records: DataFrame, names: list[str]) -> DataFrame:
    """One text column per name; a record with too few or too many cells is an error."""
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    options = {"quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST", "maxCharsPerColumn": "-1"}
    parsed = records.where(~F.col("first")).select(F.from_csv("record", schema, options).alias("cells"))
    return parsed.select(*[F.col(f"cells.c{i}").alias(name) for i, name in enumerate(names)])
