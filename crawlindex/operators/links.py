"""Link graph of domains: page links, hosts, edges and vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import is_http, unify_scheme, url_host
from ..sources.warc import links_of
from .blocks import BLOCK_ROWS, blocked_lists


def page_links(wat_pages: DataFrame) -> DataFrame:
    """`domain, links array<string>` of the pages with at least one link."""
    # Exploding no or one array, instead of a filter on its size, which Spark
    # would evaluate by parsing the JSON twice.
    found = F.filter(F.array(links_of("metadata")), lambda links: F.size(links) > 0)
    return wat_pages.select("domain", F.explode(found).alias("links"))


def links_long(wat_pages: DataFrame) -> DataFrame:
    """`domain, link`, one row per link; the same links as `page_links`."""
    return wat_pages.select("domain", F.explode(links_of("metadata")).alias("link"))


def absolute_links(links: DataFrame) -> DataFrame:
    """The http(s) links among `domain, link`, all with the scheme http."""
    return links.filter(is_http("link")).withColumn("link", unify_scheme("link"))


def link_hosts(links: DataFrame) -> DataFrame:
    """`src, dst`: domain of the page, host of each absolute link that has one."""
    return (
        absolute_links(links)
        .select(F.col("domain").alias("src"), url_host("link").alias("dst"))
        .filter(F.col("dst") != "")
    )


def host_counts(links: DataFrame) -> DataFrame:
    """`src, dst, n`: links counted per pair of hosts.

    Links that are relative or have no host count under a null `dst`: their
    pages still make the domain a vertex. The counting starts before the
    shuffle, so a link repeated on all pages of a site moves as one row. This
    small table is all the graph is built from; store it, and the crawl is
    read once.
    """
    host = F.when(is_http("link"), url_host(unify_scheme("link")))
    return (
        links.select(F.col("domain").alias("src"), F.nullif(host, F.lit("")).alias("dst"))
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def vertices_of(counts: DataFrame) -> DataFrame:
    """`domain`: every domain with a page that has links of any kind."""
    return counts.select(F.col("src").alias("domain")).distinct()


def edges_of(counts: DataFrame, vertices: DataFrame) -> DataFrame:
    """`src, dst, n`: edges between different known domains, with multiplicity.

    A domain that a third of all edges point to makes a skewed join; with
    stored inputs both sides are plain shuffles, which Spark splits by itself.
    """
    known = vertices.select(F.col("domain").alias("dst"))
    return counts.filter("src <> dst").join(known, "dst", "left_semi").select("src", "dst", "n")


def link_edges(links: DataFrame) -> DataFrame:
    """`src, dst`, parallel edges as repeated rows: no self links, known targets."""
    vertices = links.select(F.col("domain").alias("dst")).distinct()
    return (
        link_hosts(links)
        .filter("src <> dst")
        .join(vertices, "dst", "left_semi")
        .select("src", "dst")
    )


def link_vertices(links: DataFrame) -> DataFrame:
    """`domain`: every domain with a page that has links of any kind."""
    return links.select("domain").distinct()


def edge_multiplicity(edges: DataFrame) -> DataFrame:
    """`src, dst, n` from repeated `src, dst` rows."""
    return edges.groupBy("src", "dst").agg(F.count("*").alias("n"))


def out_degree(edges: DataFrame) -> DataFrame:
    """`src, out_degree` of `src, dst, n`, parallel edges counted."""
    return edges.groupBy("src").agg(F.sum("n").alias("out_degree"))


def domain_link_lists(links: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`domain, block, links`: link hosts of all pages of a domain.

    A domain without absolute links keeps an empty list.
    """
    host = F.nullif(F.when(is_http("link"), url_host(unify_scheme("link"))), F.lit(""))
    return blocked_lists(links, "domain", host, "links", host, block_rows)


def domain_index(vertices: DataFrame) -> DataFrame:
    """`index, domain`: numbers 0..N-1 that stay the same when recomputed.

    Domains are dealt by digest into 4,096 even groups, numbered inside their
    group, and moved on by the sizes of the groups before it, so that no task
    sorts all domains.
    """
    group = F.substr(F.md5("domain"), F.lit(1), F.lit(3))
    grouped = vertices.select("domain", group.alias("_group"))
    sizes = grouped.groupBy("_group").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(  # at most 4,096 rows
        "_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = F.row_number().over(Window.partitionBy("_group").orderBy("domain"))
    return (
        grouped.withColumn("_nr", within)
        .join(F.broadcast(offsets), "_group")
        .select((F.col("_offset") + F.col("_nr") - 1).alias("index"), "domain")
    )
