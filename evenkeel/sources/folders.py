"""Folders that are written beside each other, of which the newest complete one counts.

Overwriting a folder deletes it before its successor is whole. Here each write goes to a folder
of its own number; Spark's marker file, written last, makes it complete. Works on any file system
that Spark can write.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

MARKER = "_SUCCESS"


def _numbered(spark: SparkSession, path: str, name: str) -> list[tuple[int, bool]]:
    """Number and completeness of each folder ``name=number`` under ``path``."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        key, _, number = status.getPath().getName().partition("=")
        if key == name and number.isdigit():
            out.append((int(number), fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), MARKER))))
    return out


def newest_complete(spark: SparkSession, path: str, name: str) -> int | None:
    """The highest number of a complete folder; None if there is none."""
    return max((n for n, complete in _numbered(spark, path, name) if complete), default=None)


def next_number(spark: SparkSession, path: str, name: str) -> int:
    """A number above every folder's, complete or not."""
    return max((n for n, _ in _numbered(spark, path, name)), default=-1) + 1


def exists(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(root)


def complete(spark: SparkSession, path: str) -> None:
    """Mark a folder that holds several writes as complete."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, MARKER)
    marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(marker, True).close()
