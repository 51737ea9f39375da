"""Link graph and ranks on small graphs, and their plans."""

import pytest
from pyspark.sql import functions as F

from crawlindex import (
    domain_index,
    domain_link_lists,
    edge_multiplicity,
    edges_of,
    host_counts,
    link_edges,
    link_hosts,
    link_vertices,
    out_degree,
    page_rank,
    rank_names,
    top_domains,
    vertices_of,
)
from crawlindex import storage


def links(spark, *pairs):
    return spark.createDataFrame(list(pairs), "domain string, link string")


def graph(spark, *pairs):
    edges = spark.createDataFrame(list(pairs), "src string, dst string")
    vertices = edges.selectExpr("src AS domain").union(edges.selectExpr("dst")).distinct()
    return vertices, edge_multiplicity(edges)


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


SAMPLE = [
    ("a", "http://b/1"),
    ("a", "https://b/2"),
    ("a", "http://a/self"),
    ("a", "http://unknown/"),
    ("a", "http:///nohost"),
    ("b", "https://a/"),
    ("b", "/relative"),
    ("c", "/relative"),
]


def test_edges_and_vertices(spark):
    sample = links(spark, *SAMPLE)
    assert rows(link_vertices(sample)) == [("a",), ("b",), ("c",)]
    assert rows(link_hosts(sample)) == [("a", "a"), ("a", "b"), ("a", "b"), ("a", "unknown"), ("b", "a")]
    assert rows(link_edges(sample)) == [("a", "b"), ("a", "b"), ("b", "a")]


def test_counted_graph_equals_the_long_one(spark):
    sample = links(spark, *SAMPLE)
    counts = host_counts(sample)
    vertices = vertices_of(counts)
    assert rows(vertices) == rows(link_vertices(sample))
    assert rows(edges_of(counts, vertices)) == rows(edge_multiplicity(link_edges(sample)))
    assert rows(out_degree(edges_of(counts, vertices))) == [("a", 2), ("b", 1)]


def test_link_lists_keep_domains_without_absolute_links(spark):
    got = {r.domain: (r.block, r.links) for r in domain_link_lists(links(spark, *SAMPLE)).collect()}
    assert got == {"a": (0, ["a", "b", "b", "unknown"]), "b": (0, ["a"]), "c": (0, [])}


def test_link_lists_in_blocks(spark):
    many = [("hot", f"http://h{i % 7}/") for i in range(5000)] + [("cold", "http://x/")]
    table = links(spark, *many)
    lists = domain_link_lists(table, block_rows=500)
    hot = lists.filter("domain = 'hot'").collect()
    assert sorted(r.block for r in hot) == list(range(10))
    assert max(len(r.links) for r in hot) <= 510  # copies are dealt out evenly
    assert sorted(x for r in hot for x in r.links) == sorted(f"h{i % 7}" for i in range(5000))
    assert rows(lists.filter("domain = 'cold'").select("block", F.size("links"))) == [(0, 1)]
    assert rows(domain_link_lists(table.repartition(5), block_rows=500)) == rows(lists)


def test_domain_numbers_are_dense_and_stable(spark):
    vertices = spark.range(5000).selectExpr("concat('d', id) AS domain")
    first = rows(domain_index(vertices))
    assert [i for i, _ in first] == list(range(5000))
    assert rows(domain_index(vertices.repartition(3))) == first


@pytest.mark.parametrize(
    "edges, ranks",
    [
        (
            ["12", "12", "13", "23", "31", "43", "35"],
            {"1": 1.039784, "2": 0.915974, "3": 1.677695, "4": 0.326763, "5": 1.039784},
        ),
        (["12", "23", "31", "32"], {"1": 0.644432, "2": 1.192199, "3": 1.163369}),
    ],
)
def test_ranks(spark, edges, ranks):
    vertices, weighted = graph(spark, *[tuple(e) for e in edges])
    got = {r.domain: r.pageRank for r in page_rank(vertices, weighted).collect()}
    assert got == pytest.approx(ranks, abs=1e-3)
    assert sum(got.values()) == pytest.approx(len(ranks))
    exact = page_rank(vertices, weighted, tol=1e-6, rounds_per_write=20)
    assert {r.domain: r.pageRank for r in exact.collect()} == pytest.approx(ranks, abs=1e-5)


def test_ranks_with_split_sources(spark):
    pairs = [("hub", f"v{i}") for i in range(60)] + [(f"v{i}", "hub") for i in range(0, 60, 2)]
    pairs += [(f"v{i}", f"v{i * 7 % 60}") for i in range(60) if i * 7 % 60 != i]
    vertices, edges = graph(spark, *pairs)
    plain = rows(page_rank(vertices, edges, tol=None, max_iter=6))
    split = rows(page_rank(vertices, edges, tol=None, max_iter=6, split_edges=10))
    assert [d for d, _ in split] == [d for d, _ in plain]
    assert [r for _, r in split] == pytest.approx([r for _, r in plain])


def test_rounds_per_write_changes_no_rank(spark):
    pairs = [(f"v{i}", f"v{i * 3 % 11}") for i in range(11)] + [("v1", "v2"), ("v5", "v0")]
    vertices, edges = graph(spark, *pairs)
    first, *others = (
        dict(rows(page_rank(vertices, edges, tol=0.01, rounds_per_write=n))) for n in (1, 5, 7)
    )
    for other in others:
        assert other == pytest.approx(first, rel=1e-12)


def test_a_cap_that_is_too_low_is_an_error(spark):
    vertices, edges = graph(spark, ("a", "b"), ("b", "a"), ("c", "a"))
    with pytest.raises(RuntimeError, match="after 5 rounds"):
        page_rank(vertices, edges, tol=1e-9, max_iter=5)
    with pytest.raises(ValueError, match="max_iter"):
        page_rank(vertices, edges, tol=None)
    assert dict(rows(page_rank(vertices, edges, tol=1e-9)))["c"] < 1


def test_rounds_do_not_shuffle_the_edges(spark):
    from crawlindex.operators import rank

    vertices, edges = graph(spark, ("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"))
    folder = storage.new_folder(spark, "test")
    state = storage.stored(rank._start(vertices, edges, 0.15, 1_000_000), f"{folder}/s")
    moves = rank._bucketed(rank._moves(state, edges), f"{folder}/m")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for step in range(3):
            state = rank._round(moves, 0.15, step)(state)
        state.collect()
        plan = state._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP TABLE {moves.table}")
    # Each round shuffles the ranks by source and the shares by target.
    assert plan.count("Exchange hashpartitioning(src") == 3
    assert plan.count("Bucketed: true") == 3


def test_ranks_of_edge_cases(spark):
    vertices = spark.createDataFrame([("a",), ("b",)], "domain string")
    no_edges = spark.createDataFrame([], "src string, dst string, n long")
    assert rows(page_rank(vertices, no_edges)) == [("a", 1.0), ("b", 1.0)]
    assert rows(page_rank(vertices.limit(0), no_edges)) == []


def test_top_domains_and_names(spark):
    ranks = spark.createDataFrame([("b", 1.0), ("c", 2.0), ("a", 1.0)], "domain string, pageRank double")
    assert [r.domain for r in top_domains(ranks).collect()] == ["c", "a", "b"]
    index = domain_index(ranks)
    by_number = index.join(ranks, "domain").select("index", "pageRank")
    assert rows(rank_names(index, by_number)) == rows(ranks)
