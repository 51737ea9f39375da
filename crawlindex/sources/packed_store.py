"""Compressed index: page numbers and counts in variable-length codes.

Pages are numbered in the order of their URIs, in a dictionary that also holds
their rank, so neither is repeated in every posting. The postings of a keyword,
ordered by page, are cut into blocks. A block holds the differences of the page
numbers and the counts, each number in as many bytes as it needs: seven bits a
byte, least first, the top bit set but in the last. Whole batches of blocks are
coded and decoded at once, as arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.places import placed, runs
from ..shipping import ship
from ..storage import REPEATED, SMALL_GROUPS, new_folder, removed, small_splits, stored
from .index_store import (
    BUCKET_FILES,
    FILE_ROWS,
    MOST_BUCKETS,
    bucket_count,
    bucket_of,
    dealt_buckets,
    marked,
)

BLOCK_ROWS = 4_096
BROADCAST_PAGES = 2_000_000  # whose numbers, 16 bytes a page, go to all executors
_BLOCKS = "bucket int, keyword string, block long, n long, pages binary, occurences binary"


def to_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of unsigned numbers, and how many bytes each has."""
    rest = values.astype(np.uint64)
    sizes = np.ones(len(rest), np.int64)
    for bits in range(7, 64, 7):
        sizes += rest >= np.uint64(1) << np.uint64(bits)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        rows = np.flatnonzero(sizes > k)
        more = np.where(sizes[rows] > k + 1, 128, 0).astype(np.uint8)
        out[starts[rows] + k] = (rest[rows] & np.uint64(127)).astype(np.uint8) | more
        rest[rows] >>= np.uint64(7)
    return out, sizes


def from_varints(data: np.ndarray) -> np.ndarray:
    """The numbers of a code."""
    if not len(data):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    parts = (data & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.add.reduceat(parts, starts).astype(np.int64)


def _binaries(codes: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Code of several blocks as one binary each; starts are rows."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    offsets = ends[np.append(starts, len(sizes))].astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(codes)]
    )


def _packed(table: pa.Table, block: np.ndarray) -> pa.RecordBatch:
    """Rows (bucket, keyword, page, occurences) of whole blocks, sorted."""
    table = table.append_column("block", pa.array(block)).combine_chunks()
    page = table["page"].to_numpy().astype(np.int64)
    words = table["keyword"].combine_chunks().dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    keyword = words.indices.to_numpy()
    new = np.r_[True, (keyword[1:] != keyword[:-1]) | (block[1:] != block[:-1])]
    starts = np.flatnonzero(new)
    step = np.where(new, page, page - np.r_[0, page[:-1]])
    columns = [table[c].take(pa.array(starts)).combine_chunks() for c in ("bucket", "keyword", "block")]
    columns.append(pa.array(np.diff(np.r_[starts, len(page)])))
    for values in (step, table["occurences"].to_numpy()):
        columns.append(_binaries(*to_varints(values), starts))
    names = ["bucket", "keyword", "block", "n", "pages", "occurences"]
    return pa.record_batch(columns, names)


def _packer(block_rows: int) -> Callable:
    """For `mapInArrow`: rows (bucket, keyword, page, occurences) that are sorted in
    each task to its blocks of `block_rows`."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # a block that may go on in the next batch
        before = 0  # rows of its keyword that lie before it
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            table = table.combine_chunks()
            words = table["keyword"]
            place, first = runs(words.combine_chunks() if words.num_chunks != 1 else words.chunk(0))
            place[:first] += before
            block = place // block_rows
            cut = int(np.flatnonzero(place % block_rows == 0)[-1])
            if cut:
                yield _packed(table.slice(0, cut), block[:cut])
            held, before = table.slice(cut), int(place[cut])
        if held is not None:
            yield _packed(held, np.full(len(held), before // block_rows))

    return pack


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (keyword, n, pages, occurences) to rows (keyword, page, occurences)."""

    def numbers(column: pa.Array) -> np.ndarray:
        joined = b"".join(column.to_pylist())
        return from_varints(np.frombuffer(joined, np.uint8))

    for batch in batches:
        n = batch["n"].to_numpy()
        steps, rows = numbers(batch["pages"]), np.repeat(np.arange(len(n)), n)
        total = np.cumsum(steps)
        first = np.cumsum(n) - n
        before = np.where(first > 0, total[np.maximum(first - 1, 0)], 0) if len(total) else first
        yield pa.record_batch(
            [
                batch["keyword"].take(pa.array(rows)),
                pa.array(total - np.repeat(before, n), pa.int64()),
                pa.array(numbers(batch["occurences"]), pa.int32()),
            ],
            ["keyword", "page", "occurences"],
        )


@dataclass
class PackedIndex:
    """`blocks`: keyword, block, n, pages, occurences, bucket. `pages`: page,
    uri, page_rank."""

    blocks: DataFrame
    pages: DataFrame


def write_packed_index(
    postings: DataFrame,
    path: str,
    buckets: int | None = None,
    block_rows: int = BLOCK_ROWS,
    file_rows: int = FILE_ROWS,
) -> None:
    """Write ranked postings (keyword, uri, occurences, page_rank) in blocks of
    `block_rows`, in directories by bucket. Occurrences are not negative. Hot
    keywords and the pages are ordered by range partitioning; a task numbers the
    blocks of the keywords it holds.

    Postings of a stored index that come with their `bucket`, whose number is taken
    over unless another one is asked for, are read as they are stored. They are not
    dealt out either where the numbers of the pages can go to all executors.
    """
    spark = postings.sparkSession
    ship(spark)
    folder = new_folder(spark, "packed")
    dealt = dealt_buckets(postings)
    buckets = buckets or dealt
    table = postings.select("keyword", "uri", "occurences", "page_rank").where("keyword IS NOT NULL")
    if not dealt or dealt != buckets:
        table, dealt = stored(table, f"{folder}/postings", **REPEATED), None
    rows = table.count()
    if buckets is None:
        buckets = max(1, min(MOST_BUCKETS, rows // (BUCKET_FILES * file_rows)))
    pages = table.select("uri", "page_rank").distinct().withColumn("_all", F.lit(0))
    pages = placed(pages, "_all", [F.col("uri"), F.col("page_rank")], f"{folder}/pages")
    pages = pages.select(F.col("pos").alias("page"), "uri", "page_rank")
    pages = stored(pages.sortWithinPartitions("page"), f"{path}/pages")
    n_pages = pages.count()
    key = _page_key(pages, n_pages)
    numbers = stored(pages.select(key, "page"), f"{folder}/numbers")
    few = n_pages <= BROADCAST_PAGES
    numbered = table.select("keyword", key, "occurences")
    numbered = numbered.join(F.broadcast(numbers) if few else numbers, "_key").drop("_key")
    if not (dealt and few):
        numbered = stored(numbered, f"{folder}/numbered", **SMALL_GROUPS)
    numbered = numbered.select(
        bucket_of("keyword", buckets).alias("bucket"), "keyword", "page", "occurences"
    )
    keys = ["bucket", "keyword", "page", "occurences"]
    if not (dealt and few):
        # Rows that are equal in all else are parted by where they were read.
        files = max(buckets, -(-rows // file_rows))
        numbered = numbered.withColumn("_read", F.spark_partition_id())
        numbered = numbered.repartitionByRange(files, *keys, "_read").drop("_read")
    blocks = (
        numbered.sortWithinPartitions(*keys)
        .mapInArrow(_packer(block_rows), _BLOCKS)
        .withColumn("keyword", marked("keyword", buckets))
    )
    with small_splits(spark):
        blocks.write.partitionBy("bucket").parquet(f"{path}/blocks")
    removed(spark, folder)


def _page_key(pages: DataFrame, n_pages: int) -> Column:
    """`_key`: a number that no two of the pages (uri, page_rank) share, so that it
    stands for them in a join."""
    missing = [F.col(c).isNull() for c in ("uri", "page_rank")]
    for seed in count():
        key = F.xxhash64(F.lit(seed), "uri", "page_rank", *missing).alias("_key")
        if pages.select(key).distinct().count() == n_pages:
            return key


def read_packed_index(spark: SparkSession, path: str) -> PackedIndex:
    """A stored compressed index."""
    ship(spark)
    return PackedIndex(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/pages"))


def unpacked(index: PackedIndex, keywords: Sequence[str] | None = None) -> DataFrame:
    """`keyword, uri, occurences, page_rank`: all postings, or those of some
    keywords, whose bucket and name prune the blocks that are read."""
    blocks = index.blocks
    if keywords is not None:
        buckets = bucket_count(blocks)
        wanted = [bucket_of(F.lit(k), buckets) for k in keywords]
        blocks = blocks.where(F.col("bucket").isin(wanted) & F.col("keyword").isin(list(keywords)))
    rows = blocks.select("keyword", "n", "pages", "occurences").mapInArrow(
        _unpack, "keyword string, page long, occurences int"
    )
    return rows.join(index.pages, "page").select("keyword", "uri", "occurences", "page_rank")
