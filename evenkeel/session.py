"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("evenkeel")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the
    session is a local one; a cluster without the setting is an error, since
    executors elsewhere could not read what is written there.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="evenkeel-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/evenkeel/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once as parquet, read back: cuts lineage, survives lost executors.

    Preferred to caching where several passes follow, because the columnar copy
    lets each pass read only its own columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written once and read back, as long as the block lasts; then the copy is deleted.

    For several writes from one pass. A cached copy would hold a file's whole split, decoded, in each task.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
