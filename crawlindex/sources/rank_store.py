"""Ranks beside an index: renewed without writing postings anew.

The postings of an index that is written once carry the rank of their page's
domain. Where ranks change more often than pages, the index is written with the
number of the domain instead (see `domain_index`), and the ranks are kept in
versions of their own, `index, pageRank`. A look-up joins its hits with the
version it wants, so a new version is a table of one row a domain.

Numbers stay with their domains: a new version gives new domains the numbers
after the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.links import domain_index
from ..storage import removed, stored
from .marks import complete, marked_numbers


def _folder(path: str, kind: str, version: int) -> str:
    return f"{path}/{kind}/version={version}"


def rank_versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions, oldest first."""
    return [number for number, _ in marked_numbers(spark, f"{path}/complete")]


def write_ranks(ranks: DataFrame, path: str) -> int:
    """Add `ranks` (domain, pageRank) as a new version; its number.

    Domains keep the numbers of the version before; new ones get further
    numbers, domains that are gone keep theirs without a rank. A version counts
    once it is marked, after all else is written.
    """
    spark = ranks.sparkSession
    there = rank_versions(spark, path)
    version = there[-1] + 1 if there else 0
    for kind in ("domains", "ranks"):
        removed(spark, _folder(path, kind, version))
    if there:
        old = spark.read.parquet(_folder(path, "domains", there[-1]))
        last = old.agg(F.coalesce(F.max("index"), F.lit(-1))).first()[0]
        new = domain_index(ranks.join(old, "domain", "left_anti"))
        domains = old.unionByName(new.withColumn("index", F.col("index") + last + 1))
    else:
        domains = domain_index(ranks.select("domain"))
    domains = stored(domains, _folder(path, "domains", version))
    numbered = ranks.join(domains, "domain").select("index", "pageRank")
    numbered.write.parquet(_folder(path, "ranks", version))
    complete(spark, f"{path}/complete", version)
    return version


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """`index, domain` of the latest version, which has all that ever were."""
    return spark.read.parquet(_folder(path, "domains", _latest(spark, path)))


def read_ranks(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """`index, pageRank` of a version, the latest one if none is given."""
    version = _latest(spark, path) if version is None else version
    return spark.read.parquet(_folder(path, "ranks", version))


def _latest(spark: SparkSession, path: str) -> int:
    versions = rank_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete ranks in {path}")
    return versions[-1]


def with_ranks(index: DataFrame, ranks: DataFrame) -> DataFrame:
    """An index of numbered postings with the `page_rank` of a version, for all
    look-ups; postings of domains without a rank drop out.

    The predicates of a look-up are pushed below the join, so its hits alone are
    joined, with stored ranks whose size Spark knows.
    """
    ranked = ranks.select(F.col("index").alias("domain_index"), F.col("pageRank").alias("page_rank"))
    columns = [c for c in index.columns if c != "domain_index"]
    return index.join(ranked, "domain_index").select(*columns, "page_rank")
