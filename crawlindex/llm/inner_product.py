"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into geometric buckets. Each query gets a lower
bound on its k-th score from the longest vectors. Within a bucket that bound is
a threshold on the cosine. Above one, the bucket is left out; where it is high,
candidates must lie in the feasible range of a few coordinates; where it is
low, they must only be long enough. What remains is verified exactly.

Queries and candidates meet in blocks of bounded size. Pairs of a bucket and a
class of query bounds that cannot hold a result are never shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import new_folder, stored
from .shipping import ship

SCALE = 1024
K = 10
STEPS = 4  # buckets to a doubling of the length, and classes of the bounds
BLOCK_ROWS = 8192  # candidates in a block, about
GROUP_ROWS = 8192  # queries in a group, about
SEED_NUMBERS = 1 << 18  # of the longest vectors that give the first bounds
SEED_ROWS = 4096
COORDINATES = 3  # checked against their feasible range
COORDINATE_COSINE = 0.5  # from this cosine on coordinates prune more than lengths
CHUNK = 1 << 20  # products held at once
_SLACK = 1e-9  # relative; bounds are rounded to the safe side
_EXACT = 2.0**53

_LOWEST = -(1 << 40)  # class of queries that no bucket may be left out for


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, v, norm): components floor(scale * x). Rows with a null id,
    a null vector, or null or non-finite components are left out. `row` numbers
    the rows, which may share ids; store the result, so that it stays."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(
        x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(math.inf))
    )
    v = F.transform(x, lambda e: F.floor(e * scale).cast("long"))
    one = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", v.alias("v")
    )
    square = F.aggregate("v", F.lit(0.0), lambda acc, e: acc + e.cast("double") * e)
    return one.withColumn("norm", F.sqrt(square))


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """Rows of integers, padded with zeros to `size`."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), size), np.int64)
    rows = np.repeat(np.arange(len(column)), lengths)
    places = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows; as doubles where these hold them all."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _bounder(seeds: np.ndarray, seed_rows: np.ndarray, k: int):
    """Lower bound on each query's k-th score: its k-th among the seeds."""

    def bound(batches):
        for batch in batches:
            table = pa.table(batch) if not isinstance(batch, pa.Table) else batch
            query_rows = batch.column("row").to_numpy(zero_copy_only=False)
            queries = _matrix(batch.column("v"), seeds.shape[1])
            theta = np.full(len(queries), -math.inf)
            step = max(1, CHUNK // max(1, len(seeds)))
            for at in range(0, len(queries), step):
                rows = slice(at, at + step)
                score = products(queries[rows], seeds).astype(np.float64)
                score[query_rows[rows][:, None] == seed_rows[None, :]] = -math.inf
                if score.shape[1] >= k:
                    theta[rows] = np.partition(score, -k, axis=1)[:, -k]
            yield pa.record_batch(
                [*(table.column(n).combine_chunks() for n in table.column_names), pa.array(theta)],
                [*table.column_names, "theta"],
            )

    return bound


def _candidates_by_range(
    query: np.ndarray, unit: np.ndarray, cosine: float
) -> np.ndarray:
    """Rows of unit vectors whose largest query coordinates are feasible."""
    focus = np.argsort(-np.abs(query))[:COORDINATES]
    fits = np.ones(len(unit), bool)
    for f in focus:
        spread = math.sqrt(max(0.0, (1 - cosine**2) * (1 - query[f] ** 2))) + _SLACK
        middle = cosine * query[f]
        # Beyond the cosine itself nothing is lost: the range closes at q.
        low, high = middle - spread, middle + spread
        if query[f] >= cosine:
            high = math.inf
        if query[f] <= -cosine:
            low = -math.inf
        fits &= (unit[:, f] >= low) & (unit[:, f] <= high)
    return np.flatnonzero(fits)


def search_block(
    query_rows: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    query_norms: np.ndarray,
    theta: np.ndarray,
    vector_rows: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    norms: np.ndarray,
    k: int,
) -> list[tuple[int, int, int, int]]:
    """(query's row, its id, vector's id, score) of each query's best k in the
    block, of those that reach theta; ties to smaller ids."""
    order = np.lexsort((ids, -norms))
    vector_rows, ids = vector_rows[order], ids[order]
    vectors, norms = vectors[order], norms[order]
    longest = norms[0] if len(norms) else 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        needed = np.where(query_norms > 0, theta / query_norms * (1 - _SLACK), -math.inf)
        needed = np.where(np.isnan(needed), -math.inf, needed)
        cosine = needed / longest if longest > 0 else np.where(needed > 0, math.inf, -math.inf)
    found: list[tuple[int, int, int, int]] = []

    def keep(rows: np.ndarray, picked: np.ndarray, score: np.ndarray) -> None:
        for i, row in enumerate(rows):
            hits = np.flatnonzero(
                (score[i] >= theta[row]) & (vector_rows[picked] != query_rows[row])
            )
            if len(hits) > k:
                best = np.lexsort((ids[picked[hits]], -score[i][hits]))[:k]
                hits = hits[best]
            found.extend(
                (int(query_rows[row]), int(query_ids[row]), int(v), int(s))
                for v, s in zip(ids[picked[hits]], score[i][hits], strict=True)
            )

    by_range = np.flatnonzero((cosine >= COORDINATE_COSINE) & (cosine <= 1))
    if len(by_range):
        unit = vectors / np.maximum(norms, 1e-300)[:, None]
        for row in by_range:
            long_enough = int(np.searchsorted(-norms, -needed[row], side="right"))
            picked = _candidates_by_range(
                queries[row] / query_norms[row], unit[:long_enough], float(cosine[row])
            )
            if len(picked):
                score = products(queries[row : row + 1], vectors[picked])
                keep(np.array([row]), picked, score)
    by_length = np.flatnonzero(cosine < COORDINATE_COSINE)
    by_length = by_length[np.argsort(needed[by_length], kind="stable")]
    step = max(1, CHUNK // max(1, len(ids)))
    for at in range(0, len(by_length), step):
        rows = by_length[at : at + step]
        prefix = int(np.searchsorted(-norms, -needed[rows[0]], side="right"))
        keep(rows, np.arange(prefix), products(queries[rows], vectors[:prefix]))
    return found


_PAIR = ["bucket", "block", "bound", "part"]
_SCORES = "query_row long, query_id long, vec_id long, score long"


def _searcher(size: int, k: int):
    def search(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        def number(table, name):
            return table[name].to_numpy()

        rows = []
        if queries.num_rows and candidates.num_rows:
            rows = search_block(
                number(queries, "row"),
                number(queries, "vec_id"),
                _matrix(queries["v"], size),
                number(queries, "norm"),
                number(queries, "theta"),
                number(candidates, "row"),
                number(candidates, "vec_id"),
                _matrix(candidates["v"], size),
                number(candidates, "norm"),
                k,
            )
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        names = ["query_row", "query_id", "vec_id", "score"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return search


def _class(of) -> Column:
    """Geometric class of a positive number; _LOWEST for others."""
    positive = of > 0
    return F.when(positive, F.floor(F.log2(of) * STEPS)).otherwise(F.lit(_LOWEST)).cast("long")


def top_products(
    table: DataFrame, is_query: Column, k: int = K, scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer products
    with the vectors of all other rows; all, if there are fewer. Ties go to the
    smaller vec_id. Rows that share an id are queries and candidates of their
    own, also where their vectors are equal. Vectors of unequal sizes count as
    padded with zeros. No queries, no rows. Scores have to fit 64 bits.
    """
    spark = table.sparkSession
    ship(spark)
    vectors = stored(integer_vectors(table, scale), new_folder(spark, "products"))
    size = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    seed_rows = min(SEED_ROWS, SEED_NUMBERS // max(1, size)) + k + 1
    longest = vectors.orderBy(F.desc("norm"), "vec_id").limit(seed_rows)
    seeds = longest.select("row", "v").toArrow()
    bound = _bounder(_matrix(seeds["v"], size), np.asarray(seeds["row"].to_numpy(), np.int64), k)
    queries = (
        vectors.where(is_query)
        .mapInArrow(bound, "row long, vec_id long, v array<long>, norm double, theta double")
        # A vector must be this long to reach theta.
        .withColumn("bound", _class(F.when(F.col("norm") > 0, F.col("theta") / F.col("norm"))))
    )
    queries = stored(queries, new_folder(spark, "products"))
    candidates = vectors.withColumn("bucket", _class(F.col("norm")))
    # Lengths and bounds of doubles have a few thousand classes at most.
    buckets = {r["bucket"]: r["count"] for r in candidates.groupBy("bucket").count().collect()}
    bounds = {r["bound"]: r["count"] for r in queries.groupBy("bound").count().collect()}
    pairs = [
        (bucket, -(-rows // BLOCK_ROWS), low, -(-asked // GROUP_ROWS))
        for bucket, rows in buckets.items()
        for low, asked in bounds.items()
        if low == _LOWEST or low <= bucket + 1
    ]
    paired = spark.createDataFrame(pairs, "bucket long, blocks long, bound long, parts long")

    def spread(column, count):
        return F.pmod(F.xxhash64(column), F.col(count))

    left = (
        queries.join(F.broadcast(paired), "bound")
        .withColumn("part", spread("row", "parts"))
        .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select(*_PAIR, "row", "vec_id", "v", "norm", "theta")
    )
    right = (
        candidates.join(F.broadcast(paired), "bucket")
        .withColumn("block", spread("row", "blocks"))
        .withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
        .select(*_PAIR, "row", "vec_id", "v", "norm")
    )
    found = (
        left.groupBy(*_PAIR).cogroup(right.groupBy(*_PAIR)).applyInArrow(_searcher(size, k), _SCORES)
    )
    rank = F.expr("row_number() OVER (PARTITION BY query_row, query_id ORDER BY score DESC, vec_id)")
    return found.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(
        F.col("rank") <= k
    )
