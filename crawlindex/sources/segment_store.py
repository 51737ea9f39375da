"""An index that is kept up to date: segments, replaced pages, compaction.

Each crawl is written as a segment: its postings, and the URIs of all its pages,
also of those without words. A page that is crawled again replaces what earlier
segments hold of it. Nothing is rewritten for that: the writer notes the
(segment, URI) pairs that are out of date, and readers leave their postings out.
A compaction merges all segments into one, without those postings.

A segment counts from when it is marked as complete, after all else; so a write
that fails leaves the index as it was. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_folder, removed, stored
from .index_store import FILE_ROWS, bucket_count, marked, stored_postings, write_stored_index
from .marks import BASE, complete, marked_numbers

_PAGES, _POSTINGS, _REPLACED = KINDS = "pages", "postings", "replaced"


def _folder(path: str, kind: str, segment: int) -> str:
    return f"{path}/{kind}/segment={segment}"


def segments(spark: SparkSession, path: str) -> list[int]:
    """The segments that count, oldest first: from the last compacted one on."""
    marks = marked_numbers(spark, f"{path}/complete")
    base = max((number for number, is_base in marks if is_base), default=0)
    return [number for number, _ in marks if number >= base]


def append_segment(
    postings: DataFrame,
    pages: DataFrame,
    path: str,
    buckets: int | None = None,
    file_rows: int = FILE_ROWS,
) -> int:
    """Write one crawl's `postings` and the `uri` of its `pages`; its number.

    Postings of these URIs in earlier segments are out of date from then on,
    also where the page has no posting any more. `buckets` is given with the
    first segment or follows from its postings; later ones take it over.
    """
    spark = postings.sparkSession
    there = segments(spark, path)
    if there:
        known = bucket_count(_of_segments(spark, path, _POSTINGS, there))
        if buckets not in (None, known):
            raise ValueError(f"the index has {known} buckets, {buckets} do not fit in")
        buckets = known
    segment = _next(spark, path, there)
    _write_postings(postings, _folder(path, _POSTINGS, segment), buckets, file_rows)
    folder = _folder(path, _PAGES, segment)
    uris = stored(pages.where("uri IS NOT NULL").select("uri").distinct(), folder)
    if there:
        earlier = _of_segments(spark, path, _PAGES, there)
        replaced = earlier.join(uris, "uri", "left_semi")
        replaced = replaced.select("uri", F.col("segment").alias("of"))
        replaced.write.parquet(_folder(path, _REPLACED, segment))
    complete(spark, f"{path}/complete", segment)
    return segment


def _next(spark: SparkSession, path: str, there: list[int]) -> int:
    """Number of the next segment, whose folders a failed write may have left."""
    segment = there[-1] + 1 if there else 0
    for kind in KINDS:
        removed(spark, _folder(path, kind, segment))
    return segment


def _write_postings(
    postings: DataFrame, folder: str, buckets: int | None, file_rows: int
) -> None:
    """With a row of no keyword if there is none, as an index without files
    could not be read; look-ups never find it."""
    spark = postings.sparkSession
    copy = new_folder(spark, "segment")
    table = stored_postings(postings, copy)
    if table.isEmpty():
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema]
        table = spark.range(1).select(*nulls)
    write_stored_index(table, folder, buckets, file_rows=file_rows)
    removed(spark, copy)


def _of_segments(spark: SparkSession, path: str, kind: str, numbers: list[int]) -> DataFrame:
    """One table of several segments, with the number of each."""
    folders = [_folder(path, kind, s) for s in numbers]
    return spark.read.option("basePath", f"{path}/{kind}").parquet(*folders)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The postings in force, as `read_index` gives them: `keyword, uri,
    occurences[, page_rank], bucket`, ready for all look-ups.

    A look-up prunes to its buckets in each segment, and its hits are held
    against the replaced pages, whose stored size tells Spark how to join.
    """
    there = segments(spark, path)
    if not there:
        raise FileNotFoundError(f"no complete segment in {path}")
    table = _of_segments(spark, path, _POSTINGS, there)
    postings = table.where("keyword IS NOT NULL")
    if len(there) > 1:
        replaced = _of_segments(spark, path, _REPLACED, there[1:])
        replaced = replaced.select("uri", F.col("of").alias("segment")).distinct()
        postings = postings.join(replaced, ["segment", "uri"], "left_anti")
    columns = [c for c in table.columns if c not in ("segment", "bucket", "keyword")]
    return postings.select(marked("keyword", bucket_count(table)), *columns, "bucket")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """`uri, segment`: every page that was crawled, with its latest segment."""
    pages = _of_segments(spark, path, _PAGES, segments(spark, path))
    return pages.groupBy("uri").agg(F.max("segment").alias("segment"))


def compact_segments(spark: SparkSession, path: str, file_rows: int = FILE_ROWS) -> int:
    """Merge all segments into a new one without replaced postings; its number.

    The old segments are deleted after the new one counts. Readers that opened
    the index before have to open it anew.
    """
    there = segments(spark, path)
    if len(there) < 2:
        return there[-1] if there else -1
    segment = _next(spark, path, there)
    live = read_segments(spark, path)
    postings = live.drop("bucket")
    _write_postings(postings, _folder(path, _POSTINGS, segment), bucket_count(live), file_rows)
    read_pages(spark, path).select("uri").write.parquet(_folder(path, _PAGES, segment))
    complete(spark, f"{path}/complete", segment, base=True)
    for old in there:
        for kind in KINDS:
            removed(spark, _folder(path, kind, old))
        for mark in (f"{old}", f"{old}{BASE}"):
            removed(spark, f"{path}/complete/{mark}")
    return segment
