"""Small JSON files as commits that several writers can make at once.

``claim`` creates a file whole or not at all, and only if it isn't there yet: the entry is written
under a name of its own first and then moved to the wanted one, which fails where that is taken.
This is what a file system with atomic renames gives (HDFS and its like; a local one by hard links).
A store without them can't tell two writers apart, just as it can't hold a streaming checkpoint.

Readers never see an unfinished entry: names that begin with a dot are passed over, as Spark does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

Rows = Sequence[Mapping[str, Any]]


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _written(spark: SparkSession, path: str, rows: Rows):
    """A finished file beside ``path`` that nobody reads."""
    place, fs = _place(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write("".join(json.dumps(dict(r)) + "\n" for r in rows).encode())
    out.close()
    return place, fs, temporary


def claim(spark: SparkSession, path: str, rows: Rows) -> bool:
    """Create ``path`` with one JSON line per row; False if it exists already."""
    place, fs, temporary = _written(spark, path, rows)
    try:
        if fs.getScheme() != "file":
            return not fs.exists(place) and fs.rename(temporary, place)
        files, on_disk = spark._jvm.java.nio.file.Files, spark._jvm.java.io.File
        try:
            files.createLink(on_disk(place.toUri().getPath()).toPath(), on_disk(temporary.toUri().getPath()).toPath())
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True
    finally:
        fs.delete(temporary, False)


def replace(spark: SparkSession, path: str, rows: Rows) -> None:
    """Put ``path`` in place of what was there, in one step."""
    place, _, temporary = _written(spark, path, rows)
    fs = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = getattr(fs, "Options$Rename").OVERWRITE
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    fs.FileContext.getFileContext(place.toUri(), conf).rename(
        place.getFileSystem(conf).makeQualified(temporary), place.getFileSystem(conf).makeQualified(place), options
    )


def names(spark: SparkSession, folder: str) -> list[str]:
    """The entries of a folder in the order of their names; none if it isn't there."""
    place, fs = _place(spark, folder)
    if not fs.exists(place):
        return []
    return sorted(n for s in fs.listStatus(place) if not (n := s.getPath().getName()).startswith((".", "_")))


def read(spark: SparkSession, path: str) -> list[dict[str, Any]]:
    """The rows of one entry."""
    place, fs = _place(spark, path)
    stream = fs.open(place)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return [json.loads(line) for line in text.splitlines()]


def numbered(number: int) -> str:
    """An entry's name in a log: as wide as any number, so that names and numbers sort alike."""
    return f"{number:020d}.json"


def newest(spark: SparkSession, folder: str) -> int | None:
    """The highest number in a log; None if it is empty."""
    found = names(spark, folder)
    return int(found[-1].removesuffix(".json")) if found else None
