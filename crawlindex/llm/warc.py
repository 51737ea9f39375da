"""A Spark data source for WARC archives.

Reading plans one partition per file or per share of a large file. Predicates
on the record type and on headers are taken over from the query: headers are
parsed first, and the block of an unwanted record is neither decoded nor, where
the archive names the record's compressed length, read.

Writing gives one file of gzip members, one per record, for each task. Only
files whose task was committed are listed in the archive's manifest, so tasks
that ran twice leave nothing behind that is read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from ..sources.gzip_records import opened
from ..storage import new_folder
from .shipping import ship

SHARE_BYTES = 64 << 20  # of a file that one reading task gets
MANIFEST = "manifest.json"  # of the first write; later ones have names of their own
_MANIFESTS = re.compile(r"manifest(-[0-9a-f]{32})?\.json")
READ_BYTES = 4096  # inflated at a time while a head is looked for
BUFFER_BYTES = 1 << 20
ROWS = 256  # in a batch handed to Spark

_SCHEMA = (
    "record_type string, target_uri string, record_id string, refers_to string,"
    " payload_digest string, headers map<string,string>, payload binary"
)
# Columns that are header fields of their own.
_FIELDS = {
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "record_id": "WARC-Record-ID",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"  # captures carry no time here; equal runs give equal files


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop location, as `spark.checkpoint.dir` has it."""
    return opened(path)


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def gzip_member(record: bytes) -> bytes:
    """A gzip member that names its lengths in the 'sl' (skip length) field."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    head_bytes = 10 + 2 + 12
    total = head_bytes + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12)
    head += b"sl" + struct.pack("<HII", 8, total, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1"]
    for name, value in fields.items():
        if value is not None:
            clean = value.replace("\r", "%0D").replace("\n", "%0A")
            lines.append(f"{name}: {clean}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_headers(head: bytes) -> dict[str, str]:
    """Fields of a record's head; a name that comes again keeps its first value."""
    fields: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, found, value = line.partition(":")
        if found:
            fields.setdefault(name.strip(), value.strip())
    return fields


# --- reading -------------------------------------------------------------------


@dataclass
class _Share(InputPartition):
    path: str
    start: int
    end: int | None


class _Member:
    """One gzip member of an open file, inflated step by step."""

    def __init__(self, file: io.BufferedReader, start: int):
        self._file, self._start = file, start
        self._inflate = zlib.decompressobj(31)
        file.seek(start)
        self._input = file.read(READ_BYTES)
        self._fed = len(self._input)
        self.found = self._input[:2] == b"\x1f\x8b"
        self._length = None
        if len(self._input) >= 24 and self._input[3] & 4 and self._input[12:14] == b"sl":
            self._length = struct.unpack("<I", self._input[16:20])[0]

    def inflate(self) -> bytes | None:
        """Some more of the record, None at its end."""
        while not self._inflate.eof:
            if not self._input:
                self._input = self._file.read(READ_BYTES)
                self._fed += len(self._input)
                if not self._input:
                    return None
            data = self._inflate.decompress(self._input, READ_BYTES)
            self._input = self._inflate.unconsumed_tail
            if data:
                return data
        return None

    def end(self) -> int:
        """Where the next member starts; inflates on only if no length is named."""
        if self._length:
            return self._start + self._length
        while self.inflate() is not None:
            pass
        return self._start + self._fed - len(self._inflate.unused_data)


def read_members(raw, start: int, end: int | None, wanted) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of the wanted records whose members begin in the range."""
    file = io.BufferedReader(raw, BUFFER_BYTES)
    while end is None or start < end:
        member = _Member(file, start)
        if not member.found:
            return
        record = b""
        while b"\r\n\r\n" not in record:
            more = member.inflate()
            if more is None:
                break
            record += more
        head, _, block = record.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        if wanted(headers):
            parts = [block]
            while (more := member.inflate()) is not None:
                parts.append(more)
            size = int(headers.get("Content-Length", 0))
            yield headers, b"".join(parts)[:size]
        start = member.end()


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without the HTTP head of a response."""
    if headers.get("Content-Type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _manifests(store: fs.FileSystem, folder: str) -> list[str]:
    """One of each write into the folder."""
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if _MANIFESTS.fullmatch(f.base_name))


def _listed(store: fs.FileSystem, manifests: list[str]) -> list[tuple[str, list[int | None]]]:
    listed = []
    for path in manifests:
        with store.open_input_stream(path) as file:
            listed += json.loads(file.read())
    return listed


def _archives(store: fs.FileSystem, folder: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True))
    return sorted(f.path for f in found if f.path.endswith(".warc.gz"))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self._path = options["path"]
        self._tests: list[tuple[str, frozenset[str]]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality on the record type, other fields and single headers."""
        for test in filters:
            column = test.attribute
            name = _FIELDS.get(column[0]) if len(column) == 1 else None
            if len(column) == 2 and column[0] == "headers":
                name = column[1]
            if name and isinstance(test, EqualTo):
                self._tests.append((name, frozenset([test.value])))
            elif name and isinstance(test, In):
                self._tests.append((name, frozenset(test.value)))
            else:
                yield test

    def partitions(self) -> list[InputPartition]:
        store, folder = _open(self._path)
        if manifests := _manifests(store, folder):
            return [
                _Share(f"{folder}/{name}", a, b)
                for name, places in _listed(store, manifests)
                for a, b in zip(places[:-1], places[1:], strict=True)
            ]
        return [_Share(name, 0, None) for name in _archives(store, folder)]

    def read(self, partition: _Share | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an archive without files
            return

        def wanted(headers: dict[str, str]) -> bool:
            return all(headers.get(name) in values for name, values in self._tests)

        schema = pa.schema(
            [(name, pa.string()) for name in _FIELDS]
            + [("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
        )

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        store, _ = _open(self._path)
        rows, held = [], 0
        with store.open_input_file(partition.path) as raw:
            for headers, block in read_members(raw, partition.start, partition.end, wanted):
                payload = payload_of(headers, block)
                fields = [headers.get(name) for name in _FIELDS.values()]
                rows.append((*fields, list(headers.items()), payload))
                held += len(payload)
                if len(rows) >= ROWS or held >= SHARE_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)


# --- writing -------------------------------------------------------------------


@dataclass
class _Written(WriterCommitMessage):
    name: str
    places: list[int]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool = False):
        self._path = options["path"]
        self._overwrite = overwrite
        # What has no manifest yet is listed in the first one, or is lost to it.
        store, folder = _open(self._path)
        self._before = [] if _manifests(store, folder) else _archives(store, folder)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, folder = _open(self._path)
        store.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        places, place = [0], 0
        with store.open_output_stream(f"{folder}/{name}", compression=None) as file:
            for batch in iterator:
                for row in batch.to_pylist():
                    member = gzip_member(_record(row))
                    file.write(member)
                    place += len(member)
                    if place - places[-1] >= SHARE_BYTES:
                        places.append(place)
        return _Written(name, places if places[-1] == place else [*places, place])

    def commit(self, messages: list[_Written | None]) -> None:
        listed = [(m.name, m.places) for m in messages if m and len(m.places) > 1]
        store, folder = _open(self._path)
        store.create_dir(folder, recursive=True)
        old = _manifests(store, folder)
        gone = [f"{folder}/{name}" for name, _ in _listed(store, old)] if self._overwrite else []
        if self._overwrite:
            gone += self._before
        else:
            listed += [(path.removeprefix(f"{folder}/"), [0, None]) for path in self._before]
        first = self._overwrite or not old
        name = MANIFEST if first else f"manifest-{uuid.uuid4().hex}.json"
        with store.open_output_stream(f"{folder}/{name}") as file:
            file.write(json.dumps(listed).encode())
        if self._overwrite:
            for path in [*(m for m in old if m != f"{folder}/{MANIFEST}"), *gone]:
                store.delete_file(path)

    def abort(self, messages: list[_Written | None]) -> None:
        store, folder = _open(self._path)
        for message in filter(None, messages):
            store.delete_file(f"{folder}/{message.name}")


def _record(row: dict) -> bytes:
    """A response holds the payload; a revisit has headers only."""
    fields = {field: row[column] for column, field in _FIELDS.items()}
    fields |= {"WARC-Date": _DATE, **dict(row["headers"] or ())}
    if row["record_type"] != "response":
        return record_bytes(fields, b"")
    fields["Content-Type"] = "application/http; msgtype=response"
    return record_bytes(fields, _HTTP % len(row["payload"]) + row["payload"])


class WarcDataSource(DataSource):
    """`spark.read.format("warc").load(folder)`, and the same for writing."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)


# --- pages -----------------------------------------------------------------------


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, record_type and refers_to of every page.

    Of pages with equal payloads of at least `min_bytes`, those with the
    smallest page_id are responses, the others revisits of it. So is every page
    of a smaller payload, and every page of a group without any page_id, a
    response. Null html is an empty payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    captures = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha1("payload")
    )
    first = captures.groupBy("digest").agg(F.min("page_id").alias("first"))
    revisit = (F.length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return captures.join(first, "digest").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_pages(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one record per row of `pages` into the folder `path`, besides what it
    holds. Write to one folder in turn, not at the same time."""
    spark = pages.sparkSession
    ship(spark)
    spark.dataSource.register(WarcDataSource)

    @F.arrow_udf(T.StringType())
    def base32(digests: pa.Array) -> pa.Array:
        return pa.array(base64.b32encode(bytes.fromhex(d)).decode() for d in digests.to_pylist())

    def urn(column):
        return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))

    extra = F.create_map(
        F.lit("X-Payload-Bytes"), F.length("payload").cast("string")
    )
    with_revisits(pages, min_bytes).select(
        "record_type",
        F.col("url").alias("target_uri"),
        urn("page_id").alias("record_id"),
        urn("refers_to").alias("refers_to"),
        F.concat(F.lit("sha1:"), base32("digest")).alias("payload_digest"),
        extra.alias("headers"),
        F.when(F.col("record_type") == "response", F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive. Turns on filter push-down for Python sources.

    Spark keeps a loaded source together with the filters first pushed into it,
    so load anew for each query that filters differently.
    """
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").load(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from the
    archives: of a response from its payload, of a revisit from its headers."""

    @F.arrow_udf(T.StringType())
    def digest(payloads: pa.Array) -> pa.Array:
        return pa.array(digest_of(p.as_py() or b"") for p in payloads)

    def number(column):
        return F.regexp_extract(column, r"<urn:page:(-?[0-9]+)>", 1).try_cast("long")

    def of_type(kind: str) -> DataFrame:
        return read_warc(spark, path).where(F.col("record_type") == kind)

    responses = of_type("response").select(
        number("record_id").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        digest("payload").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = of_type("revisit").select(
        number("record_id").alias("page_id"),
        F.col("headers")["X-Payload-Bytes"].cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write `pages` to a new archive in the shared folder and read it back."""
    path = new_folder(pages.sparkSession, "warc")
    write_pages(pages, path, min_bytes)
    return page_records(pages.sparkSession, path)
