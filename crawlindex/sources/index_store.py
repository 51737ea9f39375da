"""The stored index: postings in Parquet, bucketed and sorted by keyword."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import REPEATED, SMALL_GROUPS, new_folder, removed, small_splits, stored

_BUCKETS = "keyword_buckets"
FILE_ROWS = 2_000_000  # which a task can sort in memory
BUCKET_FILES = 4  # a bucket is meant to have, where the number follows from the rows
MOST_BUCKETS = 65_536
# Of URIs beyond the dictionary what differs from the one before is written.
_FRONT_CODED = {"parquet.writer.version": "PARQUET_2_0"}


def bucket_of(keyword: Column | str, buckets: int) -> Column:
    """The bucket a keyword is stored in."""
    return F.pmod(F.xxhash64(keyword), F.lit(buckets)).cast("int")


def marked(keyword: str, buckets: int, block_rows: int | None = None) -> Column:
    """The keyword column with what look-ups need to know in its metadata."""
    known = {_BUCKETS: buckets} | ({"block_rows": block_rows} if block_rows else {})
    return F.col(keyword).alias(keyword, metadata=known)


def bucket_count(index: DataFrame) -> int | None:
    """Number of buckets of a stored index, None for any other table."""
    return index.schema["keyword"].metadata.get(_BUCKETS)


def dealt_buckets(postings: DataFrame) -> int | None:
    """Number of buckets of postings as `read_index` gives them, with their column
    `bucket`; None for any other table. Each file of an index holds a range of a
    bucket's keywords, so such postings are written anew where they are read."""
    return bucket_count(postings) if "bucket" in postings.columns else None


def write_index(
    postings: DataFrame,
    path: str,
    buckets: int | None = None,
    mode: str = "errorifexists",
    file_rows: int = FILE_ROWS,
    bloom: bool = False,
) -> None:
    """Write postings, ranked or not, for look-up by keyword.

    Each bucket is a directory, so a look-up lists and reads one of them. Files
    hold about `file_rows` postings: a range of a bucket's keywords, and of a
    keyword with more postings than a file holds, a range of their hashes. They
    are sorted by keyword, so Parquet statistics skip row groups and pages, then
    by URI, and URIs are written as places in a dictionary: so a posting takes no
    more bytes in an index of many pages.

    Without `buckets` their number follows from that of the postings. An append
    takes over the number the index has, and refuses another one, as look-ups
    would miss what lies in other buckets. The number is in the Parquet schema,
    where readers find it.

    With `bloom` files carry Bloom filters of their keywords: a look-up of a few
    words skips the row groups that lack them, also where a missing word lies
    between the words that are there.

    The postings are written to the shared folder first, so that counting them
    and finding the ranges does not work them out anew. Those of a stored index
    that come with their `bucket`, and keep the number of buckets, are neither
    written there nor dealt out: files are written as they are read.
    """
    spark = postings.sparkSession
    if mode == "append" and (there := _stored_buckets(spark, path)):
        if buckets not in (None, there):
            raise ValueError(f"the index has {there} buckets, {buckets} do not fit in")
        buckets = there
    dealt = dealt_buckets(postings)
    if dealt and buckets in (None, dealt):
        return _write_files(postings.drop("bucket"), path, dealt, mode, bloom)
    folder = new_folder(spark, "postings")
    table = stored_postings(postings.drop("bucket"), folder)
    write_stored_index(table, path, buckets, mode, file_rows, bloom)
    removed(spark, folder)


def stored_postings(postings: DataFrame, folder: str) -> DataFrame:
    """Postings in files as `write_stored_index` reads them best: in row groups of a
    few million rows at most, so that no task has more to deal out, and with each URI
    of a row group once."""
    return stored(postings, folder, **REPEATED, **SMALL_GROUPS)


def write_stored_index(
    table: DataFrame,
    path: str,
    buckets: int | None = None,
    mode: str = "errorifexists",
    file_rows: int = FILE_ROWS,
    bloom: bool = False,
) -> None:
    """`write_index` of postings that are in files already, by `stored_postings`. It
    does not look for an index in `path`."""
    rows = table.count()  # of file footers
    if buckets is None:
        buckets = max(1, min(MOST_BUCKETS, rows // (BUCKET_FILES * file_rows)))
    files = max(buckets, -(-rows // file_rows))
    ranged = table.repartitionByRange(
        files, bucket_of("keyword", buckets), "keyword", F.xxhash64("uri")
    )
    _write_files(ranged, path, buckets, mode, bloom)


def _write_files(table: DataFrame, path: str, buckets: int, mode: str, bloom: bool) -> None:
    """Each task writes the rows it has, sorted, by bucket."""
    keyword = marked("keyword", buckets)
    others = [c for c in table.columns if c != "keyword"]
    filters = {"parquet.bloom.filter.enabled#keyword": "true"} if bloom else {}
    ordered = table.select(
        keyword, *others, bucket_of("keyword", buckets).alias("bucket")
    ).sortWithinPartitions("bucket", "keyword", "uri")
    writer = ordered.write.mode(mode).options(**REPEATED, **_FRONT_CODED, **filters)
    with small_splits(table.sparkSession):
        writer.partitionBy("bucket").parquet(path)


def _stored_buckets(spark: SparkSession, path: str) -> int | None:
    """Bucket count of the index in `path`, None if there is none."""
    try:
        return bucket_count(read_index(spark, path))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A stored index: `keyword, uri, occurences[, page_rank], bucket`."""
    return spark.read.parquet(path)


def create_index_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Make a stored index a catalog table, unless the table exists, and read it."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path, "parquet")
        spark.catalog.recoverPartitions(table)
    return spark.table(table)
