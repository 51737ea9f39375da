import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlindex.llm import inner_product

SCHEMA = "vec_id long, embedding array<float>, label int, norm double, theta double, part int"


def brute(rows, k=10):
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for own, (q, a) in enumerate(usable):
        if q % 100:
            continue
        scores = sorted(
            (-sum(x * y for x, y in zip(a, b, strict=False)), i)
            for row, (i, b) in enumerate(usable)
            if row != own
        )
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows):
    frame = spark.createDataFrame([(i, v, 1, 2.0, 3.0, 4) for i, v in rows], SCHEMA)
    found = inner_product.top_products(frame, F.col("vec_id") % 100 == 0)
    return sorted(tuple(r) for r in found.collect())


def vectors(spread, n=1200, size=12, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, size)) * np.exp(rng.normal(0, spread, (n, 1)))
    return [(i, [float(x) for x in row]) for i, row in enumerate(v.astype(np.float32))]


@pytest.mark.parametrize("spread", [0.0, 0.5, 2.0])
def test_against_brute_force(spark, spread):
    rows = vectors(spread)
    assert run(spark, rows) == brute(rows)


def test_odd_rows_ties_and_repeats(spark):
    rows = vectors(0.3, 150)
    rows += [(1000, None), (1100, [1.0, None]), (1200, [math.nan]), (1300, [math.inf]), (None, [1.0])]
    rows += [(2000, [0.0] * 12), (2001, []), (2100, []), (100, rows[100][1])]
    rows += [(3000 + i, [0.5] * 12) for i in range(150)]
    assert run(spark, rows) == brute(rows)


def test_fewer_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, [0.5, 0.5])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []


@pytest.mark.parametrize("peaked", [True, False])
def test_block_by_coordinates_and_by_lengths(peaked):
    rng = np.random.default_rng(4)
    vectors_ = np.floor(1024 * rng.normal(size=(500, 8))).astype(np.int64)
    queries = vectors_[:20] if peaked else np.floor(1024 * rng.normal(size=(20, 8))).astype(np.int64)
    ids, norms = np.arange(500), np.linalg.norm(vectors_, axis=1)
    scores = queries @ vectors_.T
    theta = np.sort(scores, axis=1)[:, -3].astype(float)
    found = inner_product.search_block(
        np.full(20, -1), np.full(20, -1), queries, np.linalg.norm(queries, axis=1), theta,
        ids, ids, vectors_, norms, 10,
    )
    want = sorted(int(s) for row, t in zip(scores, theta, strict=True) for s in row[row >= t])
    assert sorted(s for *_, s in found) == want


def test_products_beyond_doubles_are_exact():
    a = np.array([[2**30 + 1, 3]]), np.array([[2**31 + 1, 5]])
    assert inner_product.products(*a)[0, 0] == (2**30 + 1) * (2**31 + 1) + 15


def test_two_vectors_on_one_id(spark):
    """Both are queries and candidates, and so are equal ones."""
    rows = vectors(0.3, 60)
    rows += [(100, [5.0] * 12), (100, [-5.0] * 12), (7, [9.0] * 12), (7, [9.0] * 12), (100, [5.0] * 12)]
    found = run(spark, rows)
    assert found == brute(rows)
    assert sum(r[0] == 100 for r in found) == 30
