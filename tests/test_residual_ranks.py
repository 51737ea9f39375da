"""Ranks by residuals: the fixed point of the full rounds, with falling work."""

import random

import pytest
from test_graph import graph, rows

from crawlindex import page_rank, page_rank_by_residuals, storage
from crawlindex.operators import rank


def power_law(n, seed=1):
    rng = random.Random(seed)
    return [(f"v{i}", f"v{int(n * rng.random() ** 3)}") for i in range(n) for _ in range(rng.randint(0, 4))]


def test_fixed_point(spark):
    pairs = [(a, b) for a, b in power_law(80) if a != b] + [("hub", f"v{i}") for i in range(80)]
    vertices, edges = graph(spark, *pairs)
    exact = dict(rows(page_rank(vertices, edges, tol=1e-8, rounds_per_write=20)))
    found = [
        dict(rows(page_rank_by_residuals(vertices, edges, tol=1e-8, rounds_per_write=n, split_edges=7)))
        for n in (9, 20)
    ]
    assert found[0] == pytest.approx(exact, abs=1e-6)
    assert found[1] == pytest.approx(found[0], rel=1e-12)
    assert sum(exact.values()) == pytest.approx(len(exact))


@pytest.mark.parametrize("edges, ranks", [
    ([(1, 2), (1, 2), (1, 3), (2, 3), (3, 1), (4, 3), (3, 5)],
     {"1": 1.039830, "2": 0.915903, "3": 1.677577, "4": 0.326860, "5": 1.039830}),
    ([(1, 2), (2, 3), (3, 1), (3, 2)], {"1": 0.644525, "2": 1.192157, "3": 1.163318}),
])
def test_known_ranks(spark, edges, ranks):
    vertices, weighted = graph(spark, *[(str(a), str(b)) for a, b in edges])
    assert dict(rows(page_rank_by_residuals(vertices, weighted))) == pytest.approx(ranks, abs=1e-3)


def test_active_vertices_fall_with_the_rounds(spark):
    """Most vertices of a tree settle early; a small cycle goes on."""
    pairs = [(f"t{i}", f"t{(i - 1) // 2}") for i in range(1, 255)]
    pairs += [("t0", "c1"), ("c1", "c2"), ("c2", "c1")]
    vertices, edges = graph(spark, *pairs)
    told = []
    page_rank_by_residuals(
        vertices, edges, tol=1e-6, rounds_per_write=4, progress=lambda done, n: told.append(n)
    )
    assert told[0] == 257 and told[1] <= 32 and told[2:] and set(told[3:]) <= {1, 2}
    assert told == sorted(told, reverse=True)


def joined(frame):
    frame.collect()
    todo, found = [frame._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if "Join" in kind:
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_only_active_vertices_meet_their_edges(spark):
    pairs = [(f"v{i}", f"v{j}") for i in range(30) for j in range(30) if i != j]
    vertices, edges = graph(spark, *pairs)
    folder = storage.new_folder(spark, "test")
    start = rank._start(vertices, edges, 0.0, 1_000_000)
    state = start.selectExpr("*", "if(domain = 'v3', 1D, 1e-9) AS residual")
    state = storage.stored(state, f"{folder}/s")
    moves = rank._bucketed(rank._moves(state, edges, rank._OWN), f"{folder}/m")
    try:
        after = rank._residual_round(moves, 1e-6, 0.15)(state)
        assert joined(after) == [30 + 29]  # own rows, and the edges of v3
        got = {r.domain: r for r in after.collect()}
        assert got["v3"]["rank"] == 1.0 and got["v3"].residual == 0.0
        assert got["v4"].residual == pytest.approx(1e-9 + 0.85 / 29)
    finally:
        moves.drop()


def test_cap_and_empty_graphs(spark):
    vertices, edges = graph(spark, ("a", "b"), ("b", "a"), ("c", "a"))
    tables = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(RuntimeError, match="after 5 rounds"):
        page_rank_by_residuals(vertices, edges, tol=1e-9, max_iter=5)
    with pytest.raises(RuntimeError, match="after 5 rounds"):
        page_rank(vertices, edges, tol=1e-9, max_iter=5)
    assert {t.name for t in spark.catalog.listTables()} == tables
    no_edges = edges.limit(0)
    two = vertices.where("domain <> 'c'")
    assert rows(page_rank_by_residuals(two, no_edges)) == [("a", 1.0), ("b", 1.0)]
    assert rows(page_rank_by_residuals(two.limit(0), no_edges)) == []
