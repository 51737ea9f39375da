"""Postings and the inverted index, with and without ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.index_store import dealt_buckets
from .blocks import BLOCK_ROWS, blocked_lists


def ranked_pages(pages: DataFrame, ranks: DataFrame) -> DataFrame:
    """Pages with the `pageRank` of their domain; pages without one drop out.

    Pass stored ranks: Spark broadcasts them if their size is within the
    session's threshold. Otherwise both sides are shuffled, and Spark splits a
    domain that holds too many pages.
    """
    return pages.join(ranks.select("domain", "pageRank"), "domain").select(
        "uri", "domain", "pageRank", "text"
    )


def postings(term_counts: DataFrame) -> DataFrame:
    """`keyword, uri, occurences[, page_rank]`: one row per keyword and page."""
    columns = ["keyword", "uri", F.col("keyword_weight").alias("occurences")]
    if "pageRank" in term_counts.columns:
        columns.append(F.col("pageRank").alias("page_rank"))
    return term_counts.select(*columns)


def inverted_index(postings: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`keyword, block, links, occurences[, page_ranks]` from postings.

    The arrays are parallel and sorted by uri. A keyword has one row for about
    every `block_rows` of its postings (see `blocked_lists`). Search reads the
    long postings; this is the form to export. Of a stored index with its `bucket`
    only the postings of keywords that lie in several files are moved.
    """
    fields = [c for c in ("uri", "occurences", "page_rank") if c in postings.columns]
    names = {"uri": "links", "occurences": "occurences", "page_rank": "page_ranks"}
    element, spread = F.struct(*fields), F.col("uri")
    gathered = dealt_buckets(postings) is not None
    lists = blocked_lists(postings, "keyword", element, "_postings", spread, block_rows, gathered)
    arrays = [F.col("_postings")[field].alias(names[field]) for field in fields]
    return lists.select("keyword", "block", *arrays)


def postings_by_position(index: DataFrame) -> DataFrame:
    """Parallel arrays back to long postings, element by element."""
    arrays = [c for c in ("links", "occurences", "page_ranks") if c in index.columns]
    long = index.select("keyword", F.inline(F.arrays_zip(*arrays)))
    names = {"links": "uri", "occurences": "occurences", "page_ranks": "page_rank"}
    return long.select("keyword", *[F.col(c).alias(names[c]) for c in arrays])


def index_stats(pages: DataFrame, postings: DataFrame) -> DataFrame:
    """`metric, value`: number of pages, of postings and of different keywords."""
    per_keyword = postings.groupBy("keyword").agg(F.count("*").alias("n"))
    totals = per_keyword.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("keywords_total"),
        F.count("*").alias("keywords_distinct"),
    )
    records = pages.agg(F.count("*").alias("value")).select(
        F.lit("records").alias("metric"), "value"
    )
    return records.unionByName(
        totals.unpivot([], ["keywords_total", "keywords_distinct"], "metric", "value")
    )
