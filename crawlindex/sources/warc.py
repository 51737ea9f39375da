"""Crawl archives: records, headers, text pages (WET) and page links (WAT)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import (
    BLANK_LINE,
    FIELD_SEPARATOR,
    LINE_BREAK,
    RECORD_SEPARATOR,
)
from ..functions.urls import is_http, top_level_domain, url_host
from .gzip_records import gzip_pieces

# Only the link targets are in the schema, so the JSON reader skips the rest.
_LINKS_SCHEMA = T.StructType().add(
    "Envelope",
    T.StructType().add(
        "Payload-Metadata",
        T.StructType().add(
            "HTTP-Response-Metadata",
            T.StructType().add(
                "HTML-Metadata",
                T.StructType().add(
                    "Links", T.ArrayType(T.StructType().add("url", T.StringType()))
                ),
            ),
        ),
    ),
)


def read_records(
    spark: SparkSession,
    path: str | list[str],
    partitions: int | None = None,
    split_bytes: int | None = None,
) -> DataFrame:
    """Records of crawl text files as `value`: a directory, glob or list.

    A record ends where a blank line and a line with the version mark alone
    follow, or the file ends; the mark inside a text does not end it. Values
    start with the line break after their mark and end in a blank line.

    Plain files are split by byte range. A .gz file is one task, which suits
    crawls of many thousand files. For a few large ones pass `split_bytes`: then
    each range of so many compressed bytes is a task, which starts at a gzip
    member (see `gzip_records`). `partitions` spreads the records by a shuffle
    before the parsing starts, which helps where a file is a single member.
    """
    mark = RECORD_SEPARATOR + LINE_BREAK
    if split_bytes:
        records = gzip_pieces(spark, path, split_bytes).select(F.col("value").cast("string"))
    else:
        records = spark.read.text(path, lineSep=BLANK_LINE + mark)
    value = F.col("value")
    # The first record of a file still has its mark, the last its blank line.
    start = F.when(
        value.startswith(mark), F.substr(value, F.lit(len(RECORD_SEPARATOR) + 1))
    ).when(value.startswith(LINE_BREAK), value)
    whole = F.coalesce(start, F.concat(F.lit(LINE_BREAK), value))
    ended = F.when(whole.endswith(BLANK_LINE), whole).otherwise(
        F.concat(whole, F.lit(BLANK_LINE))
    )
    records = records.select(F.when(value != "", ended).otherwise(value).alias("value"))
    return records.repartition(partitions) if partitions else records


def write_records(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a `value` column as crawl text files `read_records` reads back."""
    value = F.col("value")
    ended = F.when(
        value.endswith(BLANK_LINE), F.left(value, F.length(value) - len(BLANK_LINE))
    ).otherwise(value)
    marked = F.concat(F.lit(RECORD_SEPARATOR), ended).alias("value")
    records.select(marked).write.mode(mode).text(path, lineSep=BLANK_LINE)


def split_record(records: DataFrame, first_segment: bool = False) -> DataFrame:
    """Drop empty records and part `value` into `header` and `body`.

    The body is all after the first blank line but the blank line that ends the
    record; null when there is no blank line. With `first_segment` it stops at
    its own first blank line.
    """
    value = F.col("value")
    header = F.substring_index(value, BLANK_LINE, 1)
    rest = F.substr(value, F.length(header) + len(BLANK_LINE) + 1)
    if first_segment:
        body = F.substring_index(rest, BLANK_LINE, 1)
    else:
        body = F.when(
            rest.endswith(BLANK_LINE), F.left(rest, F.length(rest) - len(BLANK_LINE))
        ).otherwise(rest)
    return records.filter(F.length("value") > 0).select(
        header.alias("header"),
        F.when(value.contains(BLANK_LINE), body).alias("body"),
    )


def header_lines(header: Column | str) -> Column:
    """array<string> of the non-blank header lines."""
    return F.filter(F.split(header, LINE_BREAK), lambda line: line != "")


def header_fields(header: Column | str) -> Column:
    """array<struct<key, value>> in file order, cut at the first ": ".

    The value of a line without ": " is null.
    """

    def field(line: Column) -> Column:
        key = F.substring_index(line, FIELD_SEPARATOR, 1)
        value = F.when(
            line.contains(FIELD_SEPARATOR),
            F.substr(line, F.length(key) + len(FIELD_SEPARATOR) + 1),
        )
        return F.struct(key.alias("key"), value.alias("value"))

    return F.transform(header_lines(header), field)


def header_field(header: Column | str, name: str) -> Column:
    """Value of the first header line called `name`, "" when absent."""
    return F.regexp_extract(header, rf"(?s)(?:^|\r\n)\Q{name}\E: (.*?)(?:\r\n|$)", 1)


def wet_pages(
    records: DataFrame, domain: Callable[[Column], Column] = url_host
) -> DataFrame:
    """Text pages `uri, domain, text` of WET records of type "conversion".

    `domain` turns the URI into the domain ranks are joined on.
    """
    return (
        split_record(records)
        .filter(header_field("header", "WARC-Type") == "conversion")
        .select(
            header_field("header", "WARC-Target-URI").alias("uri"),
            F.col("body").alias("text"),
        )
        .select("uri", domain(F.col("uri")).alias("domain"), "text")
    )


def pages_by_top_domain(records: DataFrame) -> DataFrame:
    """Text pages `uri, topDomain, text`, as the unranked index reads them."""
    pages = wet_pages(records)
    return pages.select("uri", top_level_domain("domain").alias("topDomain"), "text")


def wat_pages(records: DataFrame) -> DataFrame:
    """Pages `uri, domain, metadata` of WAT records: JSON body, http(s) URI."""
    return (
        split_record(records)
        .filter(F.col("body").startswith("{"))
        .select(
            header_field("header", "WARC-Target-URI").alias("uri"),
            F.col("body").alias("metadata"),
        )
        .filter(is_http("uri"))
        .select("uri", url_host("uri").alias("domain"), "metadata")
        .filter(F.col("domain") != "")
    )


def links_of(metadata: Column | str) -> Column:
    """array<string> of the non-empty link URLs in a page's JSON metadata."""
    parsed = F.from_json(metadata, _LINKS_SCHEMA)
    urls = parsed["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"][
        "Links"
    ]["url"]
    return F.filter(urls, lambda url: url.isNotNull() & (url != ""))
