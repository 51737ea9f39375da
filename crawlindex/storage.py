"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# For tables that repeat long values, as URIs, in no order: with a dictionary of
# 1 MB, as is usual, values are written out as soon as there are some 20,000.
REPEATED = {"parquet.dictionary.page.size": str(16 << 20)}
SMALL_GROUPS = {"parquet.block.size": str(8 << 20)}  # for tables read in `small_splits`
_SPLIT_BYTES = 8 << 20  # of files, which as rows are many times larger
_SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"
_own_folders: dict[str, str] = {}  # by application


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach, as the cluster names it: in the setting or by
    `SparkContext.setCheckpointDir`.

    Where neither is given a local session gets a temporary folder; on a
    cluster that would be a folder of one machine, so it is refused.
    """
    folder = spark.conf.get(_SETTING, None)
    context = spark.sparkContext
    if not folder and hasattr(context, "getCheckpointDir"):
        folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder all executors can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="crawlindex-")
    return _own_folders[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(table: DataFrame, path: str, **options: str) -> DataFrame:
    """Write the table and go on from the files.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner true sizes to choose join strategies by. Options are the writer's.
    """
    table.write.options(**options).parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Files read inside are split to tasks that can hold their rows in memory.

    A shuffle to more than 200 partitions sorts all rows of a task, and spills what
    exceeds its memory. The session keeps its own setting, also if it is smaller.
    """
    before = spark.conf.get(_SPLIT_SETTING, None)
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(_SPLIT_SETTING)
    )
    spark.conf.set(_SPLIT_SETTING, str(min(now, _SPLIT_BYTES)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SPLIT_SETTING)
        else:
            spark.conf.set(_SPLIT_SETTING, before)


def removed(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
