"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import new_folder, removed, stored


def _state(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", "root")).alias("digest")
    ).first()
    return row["n"], row["digest"] or 0


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (src, dst): root is the smallest
    node reachable. Nulls and self links are left out; no links, no rows.

    Large-star and small-star rounds in turn until nothing changes. Each round
    ends in a table of the shared folder, of which the last one stays. The minimum of a node is combined
    before its shuffle and joined back, so a node with very many links is an
    ordinary skewed join, which Spark splits.
    """
    spark = links.sparkSession
    folder = new_folder(spark, "components")
    pairs = stored(
        links.select(F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("root"))
        .where("node <> root")
        .distinct(),
        f"{folder}/0",
    )
    state = _state(pairs)
    for turn in count(1):
        both = pairs.union(pairs.select("root", "node")).toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("m"))
        large = (
            both.join(least, "node")
            .where("other > node")
            .select(F.col("other").alias("node"), F.least("m", "node").alias("root"))
        )
        large = stored(large.distinct(), f"{folder}/{turn}-large")
        removed(spark, f"{folder}/{turn - 1}")
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        to_least = F.array(
            F.struct(F.col("node"), F.col("m").alias("root")),
            F.struct(F.col("root").alias("node"), F.col("m").alias("root")),
        )
        small = large.join(least, "node").select(F.inline(to_least))
        pairs = stored(small.where("node <> root").distinct(), f"{folder}/{turn}")
        removed(spark, f"{folder}/{turn}-large")
        before, state = state, _state(pairs)
        if before == state:
            roots = pairs.select(F.col("root").alias("node"), "root").distinct()
            return pairs.union(roots)
