"""The jobs: domain ranks, ranked index, unranked index."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import STOP_WORDS
from ..functions.urls import url_host
from ..operators.keywords import term_counts
from ..operators.links import edges_of, host_counts, links_long, vertices_of
from ..operators.postings import postings, ranked_pages
from ..operators.rank import page_rank
from ..sources.index_store import read_index, write_index
from ..sources.warc import read_records, wat_pages, wet_pages
from ..storage import new_folder, stored


def domain_ranks(
    wat_records: DataFrame, method: Callable[..., DataFrame] = page_rank, **rank_options
) -> DataFrame:
    """`domain, pageRank` from WAT records.

    The crawl is read once, into the counted host links, which are orders of
    magnitude smaller. `method` is `page_rank` or `page_rank_by_residuals`;
    options are those of the method.
    """
    folder = new_folder(wat_records.sparkSession, "link_graph")
    counts = stored(host_counts(links_long(wat_pages(wat_records))), f"{folder}/host_counts")
    vertices = stored(vertices_of(counts), f"{folder}/vertices")
    return method(vertices, edges_of(counts, vertices), **rank_options)


def ranked_postings(
    wet_records: DataFrame,
    ranks: DataFrame,
    domain: Callable[[Column], Column] = url_host,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """`keyword, uri, occurences, page_rank` of the pages with a ranked domain.

    Pass stored ranks, as `domain_ranks` returns them. `domain_pattern` as
    `domain` joins by the loose pattern, which loses pages.
    """
    pages = ranked_pages(wet_pages(wet_records, domain), ranks)
    return postings(term_counts(pages, stop_words))


def numbered_postings(
    wet_records: DataFrame,
    domains: DataFrame,
    domain: Callable[[Column], Column] = url_host,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """`keyword, uri, occurences, domain_index` of the pages whose domain has a
    number in `domains` (index, domain): an index of them is given its ranks at
    look-up, by `with_ranks`. Pass stored domains, as `read_domains` does."""
    numbers = domains.select(F.col("index").alias("domain_index"), "domain")
    pages = wet_pages(wet_records, domain).join(numbers, "domain")
    counts = term_counts(pages.select("uri", "domain_index", "text"), stop_words)
    return counts.select(
        "keyword", "uri", F.col("keyword_weight").alias("occurences"), "domain_index"
    )


def unranked_postings(
    wet_records: DataFrame, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """`keyword, uri, occurences` of all pages."""
    return postings(term_counts(wet_pages(wet_records).select("uri", "text"), stop_words))


def build_index(
    spark: SparkSession,
    wet_path: str | list[str],
    wat_path: str | list[str],
    index_path: str,
    buckets: int | None = None,
    mode: str = "errorifexists",
    domain: Callable[[Column], Column] = url_host,
    partitions: int | None = None,
    stop_words: Sequence[str] = STOP_WORDS,
    split_bytes: int | None = None,
    **rank_options,
) -> DataFrame:
    """Rank the domains of a crawl, index its pages, store and open the index.

    A few large .gz files would be parsed and counted in one task each:
    `split_bytes` reads them in ranges, `partitions` shuffles their records.
    Options are those of `page_rank`.
    """
    wat_records = read_records(spark, wat_path, partitions, split_bytes)
    ranks = domain_ranks(wat_records, **rank_options)
    records = read_records(spark, wet_path, partitions, split_bytes)
    index = ranked_postings(records, ranks, domain, stop_words)
    write_index(index, index_path, buckets, mode)
    return read_index(spark, index_path)
