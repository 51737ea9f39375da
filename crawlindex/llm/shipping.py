"""Makes this library known to the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()  # applications
_BATCH_ROWS = "1000"  # of whole texts that a worker holds at once


def ship(spark: SparkSession) -> None:
    """Add the package to the session as a Python file, once an application,
    and keep the batches that workers get small, for the rest of the session.

    Workers import what a function refers to. Where the driver merely put a
    folder on its own path, they would not find it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="crawlindex-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for source in sorted(_PACKAGE.rglob("*.py")):
            files.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
