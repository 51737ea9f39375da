"""Render crawl records from the test tables `pages` and `documents`.

Every document becomes a text capture: document i was found at the URL of page
i mod n, so a page is captured several times, each time with other text. Every
page becomes a metadata record with six absolute links, from a formula over
page ids, followed by the links found in its HTML.

`wet_crawl` and `wat_crawl` write a kind of records each to the shared folder as
crawl files, which are what the queries read; `crawl` writes both.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.fixed_values import RECORD_SEPARATOR
from .shipping import ship
from .sources.gzip_records import opened
from .sources.warc import write_records
from .storage import new_folder

LINKS_PER_PAGE = 6
# Each ODD_EACH-th text goes on after a blank line, with the record mark in it.
ODD_EACH = 7
ODD_TEXT = "further WARC/1.0 part"
_HREF = r'<a href="([^"]*)"'
_WARCINFO = (
    "\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields"
    "\r\n\r\nrobots: obey\r\n\r\n"
)


def crawl(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Write the crawl of the tables in `sf_dir`; the WET and the WAT path."""
    return wet_crawl(spark, sf_dir), wat_crawl(spark, sf_dir)


def wet_crawl(spark: SparkSession, sf_dir: str) -> str:
    """Write the text records of all documents; their path.

    Each task writes the records it has rendered: readers split plain files
    anyhow, so texts are not dealt out once more.
    """
    path = f"{new_folder(spark, 'crawl')}/wet"
    write_records(wet_records(spark, sf_dir), path)
    return path


def wat_crawl(spark: SparkSession, sf_dir: str) -> str:
    """Write the metadata records of all pages, as `wet_crawl` does; their path."""
    path = f"{new_folder(spark, 'crawl')}/wat"
    write_records(wat_records(spark, sf_dir), path)
    return path


def gzip_crawl(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """As `crawl`, in .gz files of one member for each record: a file for each
    task that renders records, so there are more files of a larger crawl. What has no
    text or URL has no record."""
    folder = new_folder(spark, "crawl")
    ship(spark)
    for name, records in (("wet", wet_records(spark, sf_dir)), ("wat", wat_records(spark, sf_dir))):
        rows = records.mapInArrow(_member_writer(f"{folder}/{name}"), "n long")
        rows.agg(F.sum("n")).collect()
    return f"{folder}/wet", f"{folder}/wat"


def _member_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (batch for batch in batches if batch.num_rows)
        first = next(batches, None)
        if first is None:  # no file for a task without records
            return
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        name = f"{path}/part-{TaskContext.get().partitionId():05d}.gz"
        n = 0
        with store.open_output_stream(name, compression=None) as file:
            for batch in chain([first], batches):
                for value in batch["value"].drop_null().to_pylist():
                    file.write(gzip.compress((RECORD_SEPARATOR + value).encode(), 6, mtime=0))
                    n += 1
        yield pa.record_batch([pa.array([n])], ["n"])

    return write


def crawls_by_turn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The text records of two crawls: of the documents two in three, then of the
    others those at pages with an even number."""
    third = F.col("doc_id") % 3 == 2
    second = third & (F.col("page_id") % 2 == 0)
    return wet_records(spark, sf_dir, ~third), wet_records(spark, sf_dir, second)


def wet_records(
    spark: SparkSession, sf_dir: str, part: Column | None = None
) -> DataFrame:
    """`value`: a warcinfo record and one text record per document, or per
    document of a part."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    n_pages = pages.agg(F.count("*")).scalar()
    captures = documents.withColumn("page_id", F.col("doc_id") % n_pages).join(pages, "page_id")
    captures = captures if part is None else captures.where(part)
    rendered = captures.select(
        F.concat(
            F.lit("\r\nWARC-Type: conversion\r\nWARC-Target-URI: "),
            F.col("url"),
            F.lit("\r\nContent-Type: text/plain\r\n\r\n"),
            F.col("text"),
            F.when(F.col("doc_id") % ODD_EACH == 0, f"\r\n\r\n{ODD_TEXT}").otherwise(""),
            F.lit("\r\n\r\n"),
        ).alias("value")
    )
    return _with_warcinfo(rendered)


def wat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: a warcinfo record and one metadata record per page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    n_pages = pages.agg(F.count("*")).scalar()
    k = F.explode(F.sequence(F.lit(1), F.lit(LINKS_PER_PAGE)))
    targets = pages.select("page_id", k.alias("k")).withColumn(
        "target", (F.col("page_id") * F.col("k") * 7 + F.col("k")) % n_pages
    )
    urls = pages.select(F.col("page_id").alias("target"), F.col("url").alias("link"))
    # Links are taken out of the HTML before the join, which then moves them alone.
    found = F.regexp_extract_all("html", F.lit(_HREF), F.lit(1)).alias("found")
    absolute = (
        targets.join(urls, "target")
        .groupBy("page_id")
        .agg(F.sort_array(F.collect_list(F.struct("k", "link"))).alias("absolute"))
    )
    links = F.concat(F.col("absolute.link"), F.col("found"))
    # "url" comes before the other keys, and a text holds brackets and commas.
    entries = F.transform(
        links,
        lambda url: F.struct(
            url.alias("url"), F.lit("A@/href").alias("path"), F.lit('see [1], "url"').alias("text")
        ),
    )
    body = F.to_json(
        F.struct(
            F.struct(
                F.struct(
                    F.struct(F.struct(entries.alias("Links")).alias("HTML-Metadata")).alias(
                        "HTTP-Response-Metadata"
                    )
                ).alias("Payload-Metadata")
            ).alias("Envelope")
        )
    )
    rendered = pages.select("page_id", "url", found).join(absolute, "page_id").select(
        F.concat(
            F.lit("\r\nWARC-Type: metadata\r\nWARC-Target-URI: "),
            F.col("url"),
            F.lit("\r\nContent-Type: application/json\r\n\r\n"),
            body,
            F.lit("\r\n\r\n"),
        ).alias("value")
    )
    return _with_warcinfo(rendered)


def _with_warcinfo(records: DataFrame) -> DataFrame:
    info = records.sparkSession.range(1).select(F.lit(_WARCINFO).alias("value"))
    return info.unionByName(records)
