"""Crawl records of large .gz files, by several tasks a file.

Crawl archives are written as one gzip member after another, so a reader can
start at any of them. A file is planned in byte ranges. A range is read from the
first member in it that begins with a record, over its end up to the next such
member; what lies before belongs to the range before. Members that begin inside
a record, as where a file was cut and packed anew, go with the one before them,
and a file of a single member is read whole by its first range.

A range is a task, but where there are very many small ones a task reads several
that follow each other: the driver keeps a record of each task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.fixed_values import BLANK_LINE, LINE_BREAK, RECORD_SEPARATOR
from ..shipping import ship

SPLIT_BYTES = 64 << 20  # of a file that one task gets, compressed
MANY_RANGES = 1_000  # from which on small ranges share a task
TASK_BYTES = 4 << 20  # of a file, which ranges that share a task have at most
_READ_BYTES = 1 << 20
_SLICE_BYTES = 1 << 13
_BATCH_BYTES = 8 << 20
_BATCH_ROWS = 1024
_MAGIC = b"\x1f\x8b\x08"
_MARK = (RECORD_SEPARATOR + LINE_BREAK).encode()
_END = BLANK_LINE.encode() + _MARK


@dataclass
class _Ranges(InputPartition):
    """Ranges of `split` bytes that follow each other in a file, the last to `end`."""

    path: str
    start: int
    end: int
    split: int


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop location."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), re.sub("^//+", "/", rest)
    names = {"s3a": "s3", "s3n": "s3"}
    return fs.FileSystem.from_uri(f"{names.get(scheme, scheme)}:{rest}")


def _begins_with_record(file, at: int) -> bool:
    """Whether a gzip member starts here whose text begins with a record."""
    inflate, text = zlib.decompressobj(31), b""
    file.seek(at)
    try:
        while len(text) < len(_MARK) and not inflate.eof:
            data = file.read(4096)
            if not data:
                return False
            text += inflate.decompress(data, 4096)
    except zlib.error:
        return False
    return text.startswith(_MARK)


def first_member(file, start: int, end: int) -> int | None:
    """Place of the first member in [start, end) that begins with a record."""
    at, held = start, b""
    while at < end + len(_MAGIC) - 1:
        file.seek(at)
        data = file.read(_READ_BYTES)
        if not data:
            return None
        block, place = held + data, at - len(held)
        found = block.find(_MAGIC)
        while found >= 0 and place + found < end:
            if _begins_with_record(file, place + found):
                return place + found
            found = block.find(_MAGIC, found + 1)
        at += len(data)
        held = block[1 - len(_MAGIC) :]
    return None


def _texts(file, size: int, start: int, end: int) -> Iterator[bytes | None]:
    """The text of a range, piece by piece; then None if the next range goes on."""
    at = 0 if not start else first_member(file, start, end)
    block, place = b"", 0  # what is read ahead, and where it lies
    while at is not None and at < size:
        if at >= end and _begins_with_record(file, at):
            yield None
            return
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            if not place <= at < place + len(block):
                file.seek(at)
                block, place = file.read(_READ_BYTES), at
                if not block:
                    raise EOFError(f"the last gzip member has no end, at {at}")
            # Slices, as what is left of one after a member is copied.
            data = block[at - place : at - place + _SLICE_BYTES]
            at += len(data)
            while data:
                yield inflate.decompress(data, _READ_BYTES)
                data = inflate.unconsumed_tail
        at -= len(inflate.unused_data)


def records_of(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """Records of a range, cut as by a line separator that ends them: only the
    first of the file has its mark, only the last its blank line."""
    blank = BLANK_LINE.encode()
    held = bytearray(blank if start else b"")
    first = bool(start)
    for text in _texts(file, size, start, end):
        if text is None:
            yield bytes(held.removesuffix(blank))
            return
        known = max(0, len(held) - len(_END) + 1)
        held += text
        last, found = 0, held.find(_END, known)
        while found >= 0:
            if not first:
                yield bytes(held[last:found])
            first = False
            last = found + len(_END)
            found = held.find(_END, last)
        del held[:last]
    if held and not first:
        yield bytes(held)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self._files = json.loads(options["files"])
        self._split = int(options["splitBytes"])

    def partitions(self) -> list[InputPartition]:
        step = self._split
        if sum(-(-size // step) for _, size in self._files) > MANY_RANGES:
            step *= max(1, TASK_BYTES // step)
        return [
            _Ranges(path, start, min(start + step, size), self._split)
            for path, size in self._files
            for start in range(0, size, step)
        ]

    def read(self, partition: _Ranges | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files
            return
        store, path = opened(partition.path)
        size = store.get_file_info(path).size
        rows, held = [], 0
        with store.open_input_file(path) as file:
            for start in range(partition.start, partition.end, partition.split):
                end = min(start + partition.split, partition.end)
                for record in records_of(file, size, start, end):
                    rows.append(record)
                    held += len(record)
                    if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                        yield pa.record_batch([pa.array(rows, pa.binary())], ["value"])
                        rows, held = [], 0
        if rows:
            yield pa.record_batch([pa.array(rows, pa.binary())], ["value"])


class GzipRecords(DataSource):
    """Column `value`, binary: the pieces between record marks."""

    @classmethod
    def name(cls) -> str:
        return "crawl_gzip"

    def schema(self) -> str:
        return "value binary"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def _files(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """(location, size) of the files that paths, folders and globs name."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for name in paths:
        path = hadoop.Path(name)
        store = path.getFileSystem(conf)
        matches = store.globStatus(path) or []
        if not matches:
            raise FileNotFoundError(name)
        todo = list(matches)
        while todo:
            status = todo.pop()
            own = status.getPath().getName()
            if status.isDirectory():
                todo += list(store.listStatus(status.getPath()))
            elif not own.startswith(("_", ".")):
                found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def gzip_pieces(
    spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """`value` of the .gz files in `path`, one row a record, each file in ranges
    of `split_bytes`. Files are opened by pyarrow, so their location must be one
    it knows: local, HDFS, S3, GCS."""
    files = _files(spark, [path] if isinstance(path, str) else list(path))
    if other := next((name for name, _ in files if not name.endswith(".gz")), None):
        raise ValueError(f"{other} is no .gz file")
    ship(spark)
    spark.dataSource.register(GzipRecords)
    source = spark.read.format("crawl_gzip").option("files", json.dumps(files))
    return source.option("splitBytes", split_bytes).load()
