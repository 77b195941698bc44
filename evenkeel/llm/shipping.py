"""The package on executors that don't have it.

Functions that run on executors import this package. A cluster may have it installed or get it by
``--py-files``; a session started elsewhere gets it here, as a small archive that Spark sends to
each executor once.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SENT.add(context.applicationId)
