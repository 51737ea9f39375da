"""Places of rows within their group, for groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import REPEATED, removed, stored


def placed(rows: DataFrame, group: str, order: list[Column], folder: str) -> DataFrame:
    """`rows` with `pos`, their place in `group` from 0 in the given order, and
    `n`, the number of rows in it; stored in `folder`, which the caller removes.

    Rows are range partitioned by group and order, so a group of any size is
    spread over tasks; only its count in each of them meets the others. Rows
    equal in `order` follow the place they are read at, which parts any number
    of them. Groups must not be null.
    """
    spark = rows.sparkSession
    keys = [F.col(group), *order, F.col("_tie")]
    # Stored, as range partitioning reads its input twice.
    rows = stored(rows.withColumn("_tie", F.monotonically_increasing_id()), f"{folder}/rows", **REPEATED)
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    spread = spread.withColumn("_at", F.monotonically_increasing_id())
    spread = stored(spread, f"{folder}/spread", **REPEATED)
    removed(spark, f"{folder}/rows")
    part = F.shiftright("_at", 33).alias("_part")  # as these numbers are defined
    counts = spread.groupBy(group, part).agg(
        F.count("*").alias("_here"), F.min("_at").alias("_first")
    )
    counts = stored(counts, f"{folder}/counts")
    # A group has a row for each partition it reaches into.
    whole = Window.partitionBy(group)
    before = F.sum("_here").over(whole.orderBy("_part")) - F.col("_here")
    starts = counts.select(
        group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_here").over(whole).alias("n")
    )
    result = spread.withColumn("_part", part).join(starts, [group, "_part"])
    result = result.withColumn("pos", F.col("_at") + F.col("_shift"))
    result = stored(result.drop("_part", "_at", "_shift"), f"{folder}/placed", **REPEATED)
    removed(spark, f"{folder}/spread")
    removed(spark, f"{folder}/counts")
    return result


def places_in_task(group: str) -> Callable:
    """For `mapInArrow`, on rows that are sorted by `group` in each task: the rows
    with `pos`, their place from 0 among those of the group in the task. Groups
    must not be null."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0  # the group of the row before, and its rows so far
        for batch in batches:
            if not len(batch):
                continue
            groups = batch[group]
            pos, first = runs(groups)
            if groups[0].as_py() == last:
                pos[:first] += n
            last, n = groups[-1].as_py(), int(pos[-1]) + 1
            yield pa.record_batch([*batch.columns, pa.array(pos)], [*batch.schema.names, "pos"])

    return numbered


def runs(groups: pa.Array) -> tuple[np.ndarray, int]:
    """Of sorted values the place of each among equal ones, and how many equal the
    first. There is one value at least."""
    new = np.ones(len(groups), dtype=bool)
    new[1:] = pc.not_equal(groups[1:], groups[:-1]).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(groups)])
    return np.arange(len(groups)) - np.repeat(starts, sizes), int(sizes[0])
