import random

import pytest
from pyspark.sql import functions as F

from evenkeel.functions.text import currency, mask_middle, percent, title_label
from evenkeel.session import scratch_path, scratch_root
from evenkeel.sources import records, tables
from evenkeel.sources.tables import inferred_types, read_csv, sql_query, write_csv


def test_csv_missing_texts_become_null(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n1.5,x\nNA,null\n,\nnan,N/A\n")
    rows = read_csv(spark, str(path), "a double, b string").collect()
    assert [tuple(r) for r in rows] == [(1.5, "x"), (None, None), (None, None), (None, None)]


def test_csv_cells_come_back_as_they_were(spark):
    rows = [(1, 'he said "x", y'), (2, "two\nlines"), (3, "  pad  "), (4, 'a\\"b\\'), (5, '"'), (6, None)]
    df = spark.createDataFrame(rows, "a int, b string")
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    assert sorted(tuple(r) for r in read_csv(spark, path, df.schema).collect()) == sorted(rows)


@pytest.mark.parametrize("line", ["1,x,surplus", "1"])
def test_ragged_lines_are_errors(spark, tmp_path, line):
    path = tmp_path / "in.csv"
    path.write_text(f"a,b\n1,x\n{line}\n")
    for schema in ("a int, b string", None):
        with pytest.raises(Exception, match="MALFORMED|malformed"):
            read_csv(spark, str(path), schema).select("a").collect()


def test_types_are_inferred_past_missing_texts(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("n,x,s,e\n1,NA,a,NA\nNA,2.5,7,\n3,1,null,n/a\n")
    df = read_csv(spark, str(path))
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "s": "string", "e": "double"}
    assert [tuple(r) for r in df.collect()] == [(1, None, "a", None), (None, 2.5, "7", None), (3, 1.0, None, None)]


def test_large_files_are_read_in_ranges(spark):
    """A file cut into many byte ranges gives the cells that one task finds, whatever lies across a cut."""
    rng = random.Random(3)
    texts = ["plain", 'a "quoted" word', "two\nlines", "three\n\nlines\r\nand \"more\"", "", "x" * 300, '"', "\n", "ends,\n\"", " pad "]
    rows = [(i, rng.choice(texts), rng.choice(texts)) for i in range(4000)]
    df = spark.createDataFrame(rows, "a int, b string, c string").coalesce(1)
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        got = sorted(map(tuple, read_csv(spark, path, df.schema).collect()), key=str)
        inferred = sorted(map(tuple, read_csv(spark, path).select("b", "c").collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = sorted(map(tuple, read_csv(spark, path, df.schema, whole_files=True).collect()), key=str)
    want = sorted(((a, b or None, c or None) for a, b, c in rows), key=str)
    assert got == whole == want
    assert inferred == sorted(((b or None, c or None) for _, b, c in rows), key=str)


def test_crlf_blank_lines_and_broken_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes(b'a,"b"\r\n1,"x\r\ny"\r\n\r\n2,z\r\n')
    assert sorted(map(tuple, read_csv(spark, str(path), "a int, b string").collect())) == [(1, "x\r\ny"), (2, "z")]
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, str(path), "b string, a int")
    path.write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="isn't closed"):
        read_csv(spark, str(path), "a int, b string")


def test_named_parameters_are_values(spark):
    view = spark.createDataFrame([("it's",), ("x",)], "v string")
    assert sql_query(spark, "SELECT count(*) AS n FROM named WHERE v = :v", {"named": view}, v="it's").first()["n"] == 1


def test_text_helpers(spark):
    df = spark.createDataFrame([("",), ("abcd",), ("abcde",), (None,)], "s string")
    assert [r[0] for r in df.select(mask_middle(F.col("s"))).collect()] == [None, "****", "ab***de", None]
    row = spark.range(1).select(currency(F.lit(1234567.6)), percent(F.lit(12.34)), title_label(F.lit("living_area"))).first()
    assert tuple(row) == ("$1,234,568", "12.3%", "Living Area")


def test_scratch_follows_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert scratch_path(spark, "x").startswith(scratch_root(spark))


def test_records_across_byte_ranges_and_batches(spark, tmp_path):
    # Cells with many line breaks: some records span several byte ranges, some several Arrow batches, one begins where a range ends.
    rng = random.Random(5)
    rows = [(str(i), "\n".join('"' * rng.randrange(2) + "x" * rng.randrange(30) for _ in range(rng.choice([1, 2, 5, 900])))) for i in range(120)]
    path = tmp_path / "in.csv"
    path.write_text('id,"no\nte"\n' + "".join(f'{i},"{t.replace(chr(34), chr(34) * 2)}"\n' for i, t in rows))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in zip(names, ("3000", "1", "7")):
            spark.conf.set(n, v)
        got = read_csv(spark, str(path), "id string, `no\nte` string")
        assert sorted(map(tuple, got.collect())) == sorted((i, t or None) for i, t in rows)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)



def test_numbers_are_told_from_texts_as_casts_do(spark):
    cells = ["1e5", " 7.5 ", "Infinity", "-inf", "0x1p3", "1d", "+.5", "12 Main", "1,5", '"1"', "e", "١", "infinite", "1 ", "9\t"]
    for cell in cells:
        raw = spark.createDataFrame([(cell,)], "c string")
        fits = raw.select(F.col("c").try_cast("double")).first()[0] is not None
        assert (inferred_types(raw)["c"] != "string") == fits, cell


ODD_CELLS = ["x", "", " pad ", 'say "hi"', "a,b", "two\nlines", '"', '""', "\n", "NA", "\u00e9\ufeff", "\ufeffmark", "tab\t", "'", "\\", '\\"', "0"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_files_in_ranges_and_whole_files_give_the_same(spark, monkeypatch, tmp_path, end):
    rng = random.Random(9)
    rows = [(str(i), rng.choice(ODD_CELLS), rng.choice(ODD_CELLS)) for i in range(500)]
    cell = lambda t: '"' + t.replace('"', '""') + '"' if set(t) & set('",\n') or rng.random() < 0.2 else t
    path = tmp_path / "in.csv"
    path.write_bytes(end.join(["id,b,c", *(",".join(map(cell, r)) for r in rows), ""]).encode())
    want = sorted((i, *[None if t in ("", "NA") else t for t in (b, c)]) for i, b, c in rows)
    for whole_file in (records.WHOLE_FILE, -1):
        monkeypatch.setattr(records, "WHOLE_FILE", whole_file)
        assert sorted(map(tuple, read_csv(spark, str(path), "id string, b string, c string").collect())) == want
        inferred = read_csv(spark, str(path))
        assert dict(inferred.dtypes) == {"id": "bigint", "b": "string", "c": "string"}
        assert sorted((str(i), b, c) for i, b, c in inferred.collect()) == want


def test_files_of_a_tasks_size_are_read_without_ranges(spark, monkeypatch):
    def ranges(*_):
        raise AssertionError("read in ranges")

    monkeypatch.setattr(records, "_ranges", ranges)
    monkeypatch.setattr(tables, "FILE_RECORDS", 3)
    path = scratch_path(spark, "csv")
    df = spark.range(10).selectExpr("id", "concat('\"', id, '\\n') AS t").coalesce(1)
    write_csv(df, path)
    assert spark.read.text(path).select("_metadata.file_path").distinct().count() == 4
    assert sorted(map(tuple, read_csv(spark, path).collect())) == [(i, f'"{i}\n') for i in range(10)]
    monkeypatch.setattr(records, "WHOLE_FILE", 10)
    with pytest.raises(AssertionError, match="in ranges"):
        read_csv(spark, path)


@pytest.mark.parametrize("line", ["1,x,surplus", "1"])
def test_ragged_lines_in_ranges_are_errors(spark, monkeypatch, tmp_path, line):
    monkeypatch.setattr(records, "WHOLE_FILE", -1)
    path = tmp_path / "in.csv"
    path.write_text(f"a,b\n1,x\n{line}\n")
    for schema in ("a int, b string", None):
        with pytest.raises(Exception, match="MALFORMED|malformed"):
            read_csv(spark, str(path), schema).select("a").collect()


@pytest.mark.parametrize("other", ["a,c\n1,2\n", "A,b\n1,2\n", "b,a\na,b\n"])
def test_files_with_other_headers_are_errors(spark, tmp_path, other):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "2.csv").write_text(other)
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).collect()


def test_no_header_is_an_error(spark, tmp_path):
    (tmp_path / "1.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, str(tmp_path))


def test_types_are_inferred_from_rows_past_the_first_look(spark, monkeypatch):
    monkeypatch.setattr(tables, "FIRST_LOOK", 5)
    monkeypatch.setattr(tables, "AT_ONCE", 2)
    late = {"a": "7", "b": "7.5", "c": "seven", "d": "NA", "e": "8e1"}
    raw = spark.createDataFrame([("1", "1", "1", "", "1.5")] * 50 + [tuple(late.values())], list(late)).coalesce(1)
    assert inferred_types(raw) == {"a": "bigint", "b": "double", "c": "string", "d": "double", "e": "double"}


def test_whole_numbers_are_told_from_texts_as_casts_do(spark):
    signs = ["", "+", "-", " ", "\t", "\x00", "\x1f", "\x7f", "\x85", "\u00a0", "\u2003", "\u0661", "\uff11", "a", ".", "1.", "1e1", "9" * 20]
    cells = [(f"{a}7{b}",) for a in signs for b in signs]
    df = spark.createDataFrame(cells, "c string")
    fits = df.where(F.col("c").try_cast("bigint").isNotNull())
    assert fits.count() > 30
    assert fits.where(~F.col("c").rlike(tables.WHOLE_NUMBER)).count() == 0


def test_types_of_wide_tables_without_line_breaks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tables, "AT_ONCE", 2)
    path = tmp_path / "in.csv"
    path.write_text("a,b,c\n1,NA,x\n2,1.5,3\n")
    df = read_csv(spark, str(path), multiline=False)
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string"}
    assert sorted(map(tuple, df.collect())) == [(1, None, "x"), (2, 1.5, "3")]
