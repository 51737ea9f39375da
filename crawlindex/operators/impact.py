"""Top results that stop early, from an impact-ordered index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import RESULTS_PER_PAGE
from ..sources.impact_store import TIER_FACTOR, ImpactIndex
from ..sources.index_store import bucket_of
from ..storage import new_folder, stored
from .search import Queries, _asked, _best, _with_text


def search_impact(
    index: ImpactIndex,
    queries: Queries,
    k: int = RESULTS_PER_PAGE,
    normalize: bool = False,
) -> DataFrame:
    """`query, uri, score, score_text, total`: the k best pages per query, as
    `search` gives them, and the number of all its hits.

    Only blocks that can hold a result are asked for. In a segment these are
    the first ones, up to place k. Of them, blocks go whose best score is below
    the k-th: it is known before any posting is read, from the worst scores of
    the blocks that hold k rows together. The totals come from the block table
    alone. Reading is cut to the tiers of the first k places, the buckets of
    the keywords, their rows, and scores from the least threshold on.
    """
    spark = index.postings.sparkSession
    asked = _asked(index.postings, queries, normalize)
    few = not isinstance(asked, DataFrame)
    if few:
        given = asked
        buckets = [bucket_of(F.lit(keyword), index.buckets) for _, keyword in given]
        asked = spark.createDataFrame(given, "query string, keyword string")
        asked = asked.withColumn("bucket", bucket_of("keyword", index.buckets))

    def of_keywords(table: DataFrame) -> DataFrame:
        """Literals prune directories and reach the Parquet reader."""
        if not few:
            return table
        return table.where(
            F.col("bucket").isin(buckets) & F.col("keyword").isin([word for _, word in given])
        )

    keys = ["bucket", "keyword"]
    blocks = of_keywords(index.blocks).join(asked.where("bucket >= 0"), keys)
    totals = blocks.groupBy("query", *keys).agg(F.sum("n").alias("total"))
    # At most k rows of a segment come into question, hence few of its blocks.
    first = blocks.where(F.col("block") * index.block_rows < k)
    worst_first = Window.partitionBy("query").orderBy(F.desc("worst"))
    held = F.sum("n").over(worst_first)  # with all blocks of an equal worst score
    limit = first.withColumn("held", held).where(F.col("held") >= k)
    limit = limit.groupBy("query").agg(F.max("worst").alias("limit"))
    wanted = totals.join(limit, "query", "left")
    hits = of_keywords(index.postings).where(
        (F.col("place") < k) & (F.col("tier") <= F.lit(_last_tier(k, index.block_rows)))
    )
    if few:
        least = wanted.agg(
            F.when(F.count("*") == F.count("limit"), F.min("limit")).alias("limit")
        ).first()["limit"]
        if least is not None:
            hits = hits.where(F.col("score") >= least)
    else:
        # From storage Spark knows how many there are, and prunes by them.
        wanted = stored(wanted, new_folder(spark, "queries")).where("bucket >= 0")
    hits = hits.join(wanted, keys)
    hits = hits.where(F.col("limit").isNull() | (F.col("score") >= F.col("limit")))
    place = F.row_number().over(Window.partitionBy("query").orderBy(*_best()))
    top = hits.withColumn("_place", place).where(F.col("_place") <= k)
    return _with_text(top.select("query", "uri", "score", "total")).select(
        "query", "uri", "score", "score_text", "total"
    )


def _last_tier(k: int, block_rows: int) -> int:
    """Tier of place k - 1."""
    block, tier = max(0, k - 1) // block_rows, 0
    while block >= TIER_FACTOR**tier:
        tier += 1
    return tier
