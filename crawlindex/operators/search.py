"""Look-ups in an index of postings: top results, hit counts, many queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.best_rows import best_rows
from ..functions.fixed_values import RESULTS_PER_PAGE, SCORE_FORMAT
from ..functions.text import as_keyword
from ..shipping import ship
from ..sources.index_store import bucket_count, bucket_of
from ..storage import new_folder, stored

Queries = str | Sequence[str] | DataFrame
SUM_DECIMALS = 9  # of scores that are added up
TASK_HITS = 2_000_000  # of queries of several words, about, added up by a task
SHARES = 64  # of the pages, in which the hits of a query are cut first


def keyword_lookup(index: DataFrame, keywords: str | Sequence[str]) -> DataFrame:
    """The postings of one keyword or a few; exact and case-sensitive.

    On a stored index the bucket predicate prunes directories and the keyword
    predicate reaches the Parquet reader.
    """
    keywords = [keywords] if isinstance(keywords, str) else list(keywords)
    hits = index.filter(F.col("keyword").isin(keywords))
    buckets = bucket_count(index)
    if buckets:
        hits = hits.filter(
            F.col("bucket").isin([bucket_of(F.lit(k), buckets) for k in keywords])
        )
    return hits.drop("bucket")


def scores(index: DataFrame, queries: Queries, normalize: bool = False) -> DataFrame:
    """`query, uri, score` of every posting that matches one of the queries.

    Queries are a word, a list of words or a DataFrame with a `query` column
    of any length; a repeated query counts once. score = occurences *
    page_rank. Keywords are stored in lower case, so "Word" finds nothing
    unless `normalize` cleans queries the way texts were cleaned.
    """
    return _scores(index, _asked(index, queries, normalize))


def search(
    index: DataFrame,
    queries: Queries,
    k: int = RESULTS_PER_PAGE,
    normalize: bool = False,
) -> DataFrame:
    """`query, uri, score, score_text`: the k best pages per query.

    Highest score first, ties by uri. The hits of a query are first cut to k in
    the tasks that read them, and then in each of SHARES shares of the pages,
    whatever k is, so a query that hits a third of all pages is no burden on one task.
    """
    hits = scores(index, queries, normalize)
    if isinstance(queries, str):
        top = hits.orderBy(*_best()).limit(k)
    else:
        top = _best_of_shares(hits.withColumn("_share", _share("uri")), k)
    return _with_text(top.select("query", "uri", "score"))


def search_with_totals(
    index: DataFrame,
    queries: Queries,
    k: int = RESULTS_PER_PAGE,
    normalize: bool = False,
) -> DataFrame:
    """`query, uri, score, score_text, total`: as `search`, with the number of
    all hits of the query in each row; a query without hits has no row.

    Both halves shrink before they move: results to k in each task, totals to a
    count in each task. The second half reads keywords only.
    """
    asked = _asked(index, queries, normalize)
    hits = _scores(index, asked).withColumn("_share", _share("uri"))
    top = _best_of_shares(hits, k)
    # Counted where they are read, one row a query and task moves; the columns
    # needed for that are the keyword's alone.
    totals = _matches(index, asked).groupBy("query").agg(F.count("*").alias("total"))
    top = top.join(totals, "query").select("query", "uri", "score", "total")
    return _with_text(top).select("query", "uri", "score", "score_text", "total")


def hit_counts(index: DataFrame, queries: Queries, normalize: bool = False) -> DataFrame:
    """`query, hits`: number of postings per query, 0 for a miss. Ranks are not
    needed."""
    asked = _asked(index, queries, normalize)
    found = _matches(index, asked).groupBy("query").agg(F.count("*").alias("_hits"))
    if not isinstance(asked, DataFrame):
        asked = index.sparkSession.createDataFrame(asked, "query string, keyword string")
    return asked.join(found, "query", "left").select(
        "query", F.coalesce("_hits", F.lit(0).cast("long")).alias("hits")
    )


def search_multi(
    index: DataFrame,
    keywords: Sequence[str],
    k: int | None = RESULTS_PER_PAGE,
    normalize: bool = False,
) -> DataFrame:
    """`uri, matched, score` for several keywords asked together.

    The result lists are appended and a page's scores added up, which raises
    pages that several keywords hit. `k=None` keeps all pages. One shuffle, by
    page, serves the keywords and the pages.
    """
    hits = scores(index, list(dict.fromkeys(keywords)), normalize)
    pages = hits.groupBy("uri").agg(
        F.count_distinct("query").alias("matched"), _sum("score").alias("score")
    )
    return pages if k is None else pages.orderBy(*_best()).limit(k)


def search_multi_batch(
    index: DataFrame, queries: DataFrame, k: int = RESULTS_PER_PAGE, normalize: bool = False
) -> DataFrame:
    """`query, uri, matched, score`: the k best pages for each of a table of
    queries of several words (a `query` column).

    Queries are split at white space; a word that comes again counts once.
    `normalize` cleans each word the way texts were cleaned.
    """
    spark = index.sparkSession
    # Numbered, so that no hit carries the text of its query.
    numbered = queries.select("query").distinct()
    numbered = numbered.withColumn("_number", F.monotonically_increasing_id())
    numbered = stored(numbered, new_folder(spark, "queries"))
    word = F.explode(F.split("query", r"\s+")).alias("_word")
    words = numbered.select("_number", word).filter("_word <> ''")
    keyword = as_keyword("_word") if normalize else F.col("_word")
    asked = words.select("_number", keyword.alias("keyword")).filter("keyword <> ''").distinct()
    asked = stored(asked, new_folder(spark, "queries"))
    lookups = _stored_queries(index, asked.groupBy("keyword").agg(F.count("*").alias("_queries")))
    found = _matches(index, lookups)
    # Read from the keyword column; the tasks follow from what they will hold.
    hits = found.agg(F.coalesce(F.sum("_queries"), F.lit(0))).first()[0]
    tasks = max(1, -(-hits // TASK_HITS))
    # A posting moves once, to its page, however many queries ask for it. There
    # it meets its queries, and their pages are added up and cut where they are.
    of_page = _scored(found).select("uri", "keyword", "score").repartition(tasks, "uri")
    of_page = of_page.groupBy("uri", "keyword").agg(F.sum("score").alias("score"))
    pages = of_page.join(asked, "keyword").groupBy("_number", "uri").agg(
        F.count("*").alias("matched"), _sum("score").alias("score")
    )
    # Shares are of the tasks, so a task sends k rows a query.
    share = (F.spark_partition_id() % SHARES).alias("_share")
    top = _best_of_shares(pages.select("*", share), k, "_number")
    return top.join(numbered, "_number").select("query", "uri", "matched", "score")


def _best() -> list[Column]:
    return [F.desc("score"), F.asc("uri")]


def _sum(score: str) -> Column:
    """Rounded, so that the order of adding decides no tie."""
    return F.round(F.sum(score), SUM_DECIMALS)


def _share(uri: str) -> Column:
    return F.pmod(F.xxhash64(uri), F.lit(SHARES)).cast("int")


def _best_of_shares(hits: DataFrame, k: int, query: str = "query") -> DataFrame:
    """The k best rows of each query: of a task first, without sorting all its hits,
    then in two steps by its shares."""
    ship(hits.sparkSession)
    hits = hits.mapInArrow(best_rows(query, k), hits.schema)
    for keys in ([query, "_share"], [query]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*_best()))
        hits = hits.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")
    return hits


def _with_text(top: DataFrame) -> DataFrame:
    return top.withColumn("score_text", F.format_string(SCORE_FORMAT, "score"))


def _asked(
    index: DataFrame, queries: Queries, normalize: bool
) -> DataFrame | list[tuple[str, str]]:
    """Distinct (query, keyword to look up): a list only if one was given."""
    spark = index.sparkSession
    keyword = as_keyword("query") if normalize else F.col("query")
    if isinstance(queries, DataFrame):
        asked = queries.select("query").distinct().withColumn("keyword", keyword)
        return _stored_queries(index, asked)
    given = [queries] if isinstance(queries, str) else list(dict.fromkeys(queries))
    if not normalize:
        return [(word, word) for word in given]
    asked = spark.createDataFrame([(word,) for word in given], "query string")
    return [tuple(row) for row in asked.select("query", keyword).collect()]


def _stored_queries(index: DataFrame, asked: DataFrame) -> DataFrame:
    """Queries with the bucket their keyword is in, written to the shared folder.

    From storage Spark knows the size: few queries are broadcast, and their
    buckets prune the index as it is read; many are shuffled with the postings,
    where Spark can split a hot keyword.
    """
    buckets = bucket_count(index)
    if buckets:
        asked = asked.withColumn("bucket", bucket_of("keyword", buckets))
    return stored(asked, new_folder(index.sparkSession, "queries"))


def _matches(index: DataFrame, asked: DataFrame | list[tuple[str, str]]) -> DataFrame:
    """The postings that match, with their `query`."""
    if isinstance(asked, DataFrame):
        if "bucket" in asked.columns:
            # Spark prunes by a joined table only if that is filtered itself.
            return index.join(asked.filter("bucket >= 0"), ["bucket", "keyword"])
        return index.join(asked, "keyword")
    hits = keyword_lookup(index, [keyword for _, keyword in asked])
    if all(query == keyword for query, keyword in asked):
        return hits.withColumn("query", F.col("keyword"))
    pairs = index.sparkSession.createDataFrame(asked, "query string, keyword string")
    return hits.join(pairs, "keyword")


def _scored(matches: DataFrame) -> DataFrame:
    return matches.withColumn("score", F.col("occurences") * F.col("page_rank"))


def _scores(index: DataFrame, asked: DataFrame | list[tuple[str, str]]) -> DataFrame:
    return _scored(_matches(index, asked)).select("query", "uri", "score")
