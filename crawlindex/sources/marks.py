"""Marks: which numbered parts of a stored table are complete."""

from __future__ import annotations

from pyspark.sql import SparkSession

BASE = ".base"  # ends the mark of a part that all earlier ones are in


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders a glob finds."""
    found = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in store.globStatus(found) or []]


def complete(spark: SparkSession, folder: str, number: int, base: bool = False) -> None:
    """Let a part count: one empty file, which is there at once or not at all."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{number}{BASE if base else ''}")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark).close()


def marked_numbers(spark: SparkSession, folder: str) -> list[tuple[int, bool]]:
    """(number, whether it is a base) of the marks, by number."""
    names = _matching(spark, f"{folder}/*")
    return sorted((int(name.removesuffix(BASE)), name.endswith(BASE)) for name in names)
