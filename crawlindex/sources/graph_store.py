"""A link graph that is kept up to date crawl by crawl.

For each crawl the counted host links of its pages are stored, and the URIs of
all of them. A page that is crawled again takes its earlier links out: they are
counted with a negative sign, its new links with a positive one, and the sums
are added to the counts of the graph. So an update reads the counts of earlier
pages, never an earlier crawl, and moves the rows of the pages it renews.

A crawl counts once it is marked, after all else is written. One writer at a
time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import is_http, unify_scheme, url_host
from ..storage import removed, stored
from .marks import complete, marked_numbers
from .warc import links_of

_LINKS, _PAGES, _COUNTS = KINDS = "links", "pages", "counts"


def _folder(path: str, kind: str, crawl: int) -> str:
    return f"{path}/{kind}/crawl={crawl}"


def crawls(spark: SparkSession, path: str) -> list[int]:
    """The complete crawls, oldest first."""
    return [number for number, _ in marked_numbers(spark, f"{path}/complete")]


def page_host_counts(wat_pages: DataFrame) -> DataFrame:
    """`uri, src, dst, n`: host links counted per page, as `host_counts` does
    for all; links without a host come under a null `dst`."""
    links = wat_pages.select("uri", F.col("domain").alias("src"), F.explode(links_of("metadata")).alias("link"))
    host = F.nullif(F.when(is_http("link"), url_host(unify_scheme("link"))), F.lit(""))
    return links.groupBy("uri", "src", host.alias("dst")).agg(F.count("*").alias("n"))


def update_link_graph(wat_pages: DataFrame, path: str) -> int:
    """Take a crawl (`uri, domain, metadata`) into the graph; its number.

    Every page of it replaces what the graph holds of that URI, also if it has
    no links any more. Several captures of a page in one crawl add up.
    """
    spark = wat_pages.sparkSession
    there = crawls(spark, path)
    crawl = there[-1] + 1 if there else 0
    for kind in KINDS:  # what a failed update has left
        removed(spark, _folder(path, kind, crawl))
    links = stored(page_host_counts(wat_pages), _folder(path, _LINKS, crawl))
    pages = stored(wat_pages.select("uri").distinct(), _folder(path, _PAGES, crawl))
    change = links.select("src", "dst", "n")
    if there:
        gone = _latest_links(spark, path, there, pages)
        old = spark.read.parquet(_folder(path, _COUNTS, there[-1]))
        change = change.unionByName(gone.select("src", "dst", (-F.col("n")).alias("n"))).unionByName(old)
    counts = change.groupBy("src", "dst").agg(F.sum("n").alias("n")).where("n <> 0")
    counts.write.parquet(_folder(path, _COUNTS, crawl))
    complete(spark, f"{path}/complete", crawl)
    for older in there:
        removed(spark, _folder(path, _COUNTS, older))
    return crawl


def _latest_links(
    spark: SparkSession, path: str, numbers: list[int], pages: DataFrame
) -> DataFrame:
    """The link counts in force of the pages given."""

    def of_crawls(kind: str) -> DataFrame:
        folders = [_folder(path, kind, number) for number in numbers]
        table = spark.read.option("basePath", f"{path}/{kind}").parquet(*folders)
        return table.join(pages, "uri", "left_semi")

    latest = of_crawls(_PAGES).groupBy("uri").agg(F.max("crawl").alias("crawl"))
    return of_crawls(_LINKS).join(latest, ["uri", "crawl"])


def read_link_graph(spark: SparkSession, path: str) -> DataFrame:
    """`src, dst, n` as `host_counts` gives them, of all pages as last crawled:
    what `vertices_of` and `edges_of` take."""
    there = crawls(spark, path)
    if not there:
        raise FileNotFoundError(f"no complete crawl in {path}")
    return spark.read.parquet(_folder(path, _COUNTS, there[-1]))
