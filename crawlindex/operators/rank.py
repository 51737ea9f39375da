"""PageRank of a weighted link graph as an iterative DataFrame job."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import RANK_TOLERANCE, RESET_PROBABILITY
from ..storage import new_folder, removed, stored

_SPLIT_EDGES = 1_000_000
_MAX_HOT_SOURCES = 100_000
_BUCKET_MOVES = 2_000_000
_OWN = -1  # part of the rows to the vertices themselves, where it is one of its own


def page_rank(
    vertices: DataFrame,
    edges: DataFrame,
    tol: float | None = RANK_TOLERANCE,
    reset: float = RESET_PROBABILITY,
    max_iter: int | None = None,
    rounds_per_write: int = 5,
    split_edges: int = _SPLIT_EDGES,
) -> DataFrame:
    """`domain, pageRank` of `domain` vertices and `src, dst, n` edges.

    rank(v) = reset + (1 - reset) * sum of rank(u) * n(u, v) / out_degree(u),
    up to the first round in which no rank moves by more than `tol`, then scaled
    to sum to the number of vertices. There is no cap on the rounds; if a
    `max_iter` is given and not enough, this is an error. With `tol=None` it is
    just `max_iter` rounds. The rank of a vertex without out-edges is not handed
    on.

    Every `rounds_per_write` rounds form one plan, which ends in a table in the
    shared folder. Edges are stored in buckets of their source, so no round
    shuffles them. A plan keeps the ranks of each of its rounds; so the round
    that ends it all is the same, however many rounds a plan has.
    """
    if tol is None and max_iter is None:
        raise ValueError("without a tolerance max_iter is needed")
    spark = vertices.sparkSession
    folder = new_folder(spark, "page_rank")
    edges = stored(edges.select("src", "dst", "n"), f"{folder}/edges")
    state = stored(_start(vertices, edges, reset, split_edges), f"{folder}/ranks-0")
    moves = _bucketed(_moves(state, edges), f"{folder}/moves")
    n_vertices = state.count()
    steps = [_round(moves, reset, i) for i in range(rounds_per_write)]

    done, final = 0, None
    try:
        while final is None and done != max_iter:
            rounds = _rounds(rounds_per_write, max_iter, done)
            for step in steps[:rounds]:
                state = step(state)
            previous = f"{folder}/ranks-{done}"
            done += rounds
            state = stored(state, f"{folder}/ranks-{done}")
            removed(spark, previous)
            names = [*(f"rank_{i}" for i in range(rounds)), "rank"]
            if tol is not None:
                pairs = zip(names, names[1:], strict=False)
                moved = state.agg(
                    *[F.max(F.abs(F.col(new) - F.col(old))).alias(new) for old, new in pairs]
                ).first()
                final = next((n for n in names[1:] if moved[n] is None or moved[n] <= tol), None)
            state = state.select("domain", *names[1:], "out_degree", "splits")
            if final is None:
                state = state.select("domain", "rank", "out_degree", "splits")
    finally:
        moves.drop()
        removed(spark, f"{folder}/edges")
    if tol is not None and final is None:
        raise RuntimeError(f"ranks still move by more than {tol} after {done} rounds")
    return _scaled(state, F.col(final or "rank"), n_vertices)


def page_rank_by_residuals(
    vertices: DataFrame,
    edges: DataFrame,
    tol: float = RANK_TOLERANCE,
    reset: float = RESET_PROBABILITY,
    max_iter: int | None = None,
    rounds_per_write: int = 5,
    split_edges: int = _SPLIT_EDGES,
    progress: Callable[[int, int], None] | None = None,
) -> DataFrame:
    """`domain, pageRank` as `page_rank`, by sending changes only.

    A vertex holds its rank and a residual, the change it has not handed on yet;
    at first that is `reset`. In a round only vertices whose residual exceeds
    `tol` take part: each adds it to its rank and sends (1 - reset) of it along
    its edges. Only their edges are joined, so the work of a round falls as the
    ranks settle. It ends when no vertex is active; what the residuals still
    hold, `tol` a vertex at most, is added. A `max_iter` that is not enough is
    an error. `progress` is told the round and its active vertices, once a plan.

    Plans, buckets and hot sources are those of `page_rank`; a round without
    active vertices changes nothing, so the result does not depend on
    `rounds_per_write`.
    """
    spark = vertices.sparkSession
    folder = new_folder(spark, "page_rank")
    edges = stored(edges.select("src", "dst", "n"), f"{folder}/edges")
    start = _start(vertices, edges, 0.0, split_edges).withColumn("residual", F.lit(reset))
    state = stored(start, f"{folder}/ranks-0")
    moves = _bucketed(_moves(state, edges, _OWN), f"{folder}/moves")
    n_vertices = state.count()
    step = _residual_round(moves, tol, reset)

    done = 0
    try:
        while active := state.where(F.col("residual") > tol).count():
            if progress:
                progress(done, active)
            if done == max_iter:
                raise RuntimeError(f"residuals still exceed {tol} after {done} rounds")
            rounds = _rounds(rounds_per_write, max_iter, done)
            for _ in range(rounds):
                state = step(state)
            previous = f"{folder}/ranks-{done}"
            done += rounds
            state = stored(state, f"{folder}/ranks-{done}")
            removed(spark, previous)
    finally:
        moves.drop()
        removed(spark, f"{folder}/edges")
    return _scaled(state, F.col("rank") + F.col("residual"), n_vertices)


def _rounds(rounds_per_write: int, max_iter: int | None, done: int) -> int:
    return rounds_per_write if max_iter is None else min(rounds_per_write, max_iter - done)


def _scaled(state: DataFrame, rank: Column, n_vertices: int) -> DataFrame:
    """Ranks that sum to the number of vertices."""
    total = state.agg(F.sum(rank)).first()[0]
    scale = n_vertices / total if n_vertices else 1.0
    return state.select("domain", (rank * scale).alias("pageRank"))


def top_domains(ranks: DataFrame) -> DataFrame:
    """Ranks, highest first, ties by domain."""
    return ranks.orderBy(F.desc("pageRank"), "domain")


def rank_names(domain_index: DataFrame, index_ranks: DataFrame) -> DataFrame:
    """`domain, pageRank` of ranks that are keyed by `index`."""
    return domain_index.join(index_ranks, "index").select("domain", "pageRank")


def _start(
    vertices: DataFrame, edges: DataFrame, reset: float, split_edges: int
) -> DataFrame:
    """`domain, rank, out_degree, splits`, one row per vertex.

    A source with very many edges is split, so that its edges do not meet in
    one task. The split size grows with the graph to keep the split sources
    below a fixed number.
    """
    split_edges = max(split_edges, edges.count() // _MAX_HOT_SOURCES)
    out = edges.groupBy(F.col("src").alias("domain")).agg(
        F.sum("n").alias("out_degree"),
        F.ceil(F.count("*") / split_edges).cast("int").alias("splits"),
    )
    return (
        vertices.select("domain")
        .join(out, "domain", "left")
        .select(
            "domain",
            F.lit(reset).alias("rank"),
            "out_degree",
            F.coalesce("splits", F.lit(1)).alias("splits"),
        )
    )


def _moves(state: DataFrame, edges: DataFrame, own_part: int = 0) -> DataFrame:
    """Edges `src, part, dst, n`, and one more row per vertex to itself.

    That row, in `own_part`, has n = 0 and carries what a round has to keep of the vertex, so
    a round needs one join and one aggregation, and no vertex is lost for
    having no in-edges.
    """
    hot = state.filter("splits > 1").select(  # at most _MAX_HOT_SOURCES rows
        F.col("domain").alias("src"), F.col("splits").alias("hot_splits")
    )
    part = F.pmod(F.xxhash64("dst"), F.coalesce("hot_splits", F.lit(1))).cast("int")
    links = edges.join(F.broadcast(hot), "src", "left").select(
        "src",
        part.alias("part"),
        "dst",
        "n",
        F.lit(None).cast("long").alias("out_degree"),
        F.lit(None).cast("int").alias("splits"),
    )
    kept = state.select(
        F.col("domain").alias("src"),
        F.lit(own_part).alias("part"),
        F.col("domain").alias("dst"),
        F.lit(0).cast("long").alias("n"),
        "out_degree",
        "splits",
    )
    return links.unionByName(kept)


class _Bucketed:
    """A table stored in buckets of `src, part`, to join on without a shuffle."""

    def __init__(self, spark: SparkSession, table: str, path: str):
        self.spark, self.table, self.path = spark, table, path
        self.frame = spark.table(table)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.table}")
        removed(self.spark, self.path)


def _bucketed(moves: DataFrame, path: str) -> _Bucketed:
    spark = moves.sparkSession
    table = f"moves_{uuid.uuid4().hex}"
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    moves = stored(moves, f"{path}-unsorted")
    buckets = max(partitions, moves.count() // _BUCKET_MOVES)
    (
        moves.filter("dst IS NOT NULL")
        .repartition(buckets, "src", "part")
        .write.bucketBy(buckets, "src", "part")
        .sortBy("src", "part")
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
    removed(spark, f"{path}-unsorted")
    return _Bucketed(spark, table, path)


def _round(moves: _Bucketed, reset: float, step: int) -> Callable[[DataFrame], DataFrame]:
    """The round number `step` of a plan, from the state of the vertices to their
    next state, which keeps the ranks of the plan's earlier rounds.

    The columns are made once and used in all plans: making them takes longer
    than a round over a small graph.
    """
    earlier = [f"rank_{i}" for i in range(step)]
    shares = [
        F.col("domain").alias("src"),
        F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("part"),
        *earlier,
        F.col("rank"),
        (F.col("rank") / F.col("out_degree")).alias("share"),
    ]
    # Without out-edges the share is null and only the vertex's own row, with
    # n = 0, comes along.
    inflow = F.coalesce(F.col("share") * F.col("n"), F.lit(0.0))
    vertex = F.col("dst").alias("domain")
    own = F.col("n") == 0
    summed = [
        (reset + (1 - reset) * F.sum(inflow)).alias("rank"),
        *[F.max(F.when(own, F.col(name))).alias(name) for name in earlier],
        F.max(F.when(own, F.col("rank"))).alias(f"rank_{step}"),
        F.max("out_degree").alias("out_degree"),
        F.max("splits").alias("splits"),
    ]
    keys = ["src", "part"]

    def next_state(state: DataFrame) -> DataFrame:
        return state.select(*shares).join(moves.frame, keys).groupBy(vertex).agg(*summed)

    return next_state


def _residual_round(
    moves: _Bucketed, tol: float, reset: float
) -> Callable[[DataFrame], DataFrame]:
    """A round over the active vertices: those with a residual above `tol`.

    Others only meet their own row, which lies in a part of its own.
    """
    active = F.col("residual") > tol
    sent = F.when(active, F.col("residual")).otherwise(F.lit(0.0))
    parts = F.when(active, F.sequence(F.lit(_OWN), F.col("splits") - 1))
    sends = [
        F.col("domain").alias("src"),
        F.explode(F.coalesce(parts, F.array(F.lit(_OWN)))).alias("part"),
        (F.col("rank") + sent).alias("rank"),
        (F.col("residual") - sent).alias("residual"),
        (sent / F.col("out_degree")).alias("share"),
    ]
    own = F.col("n") == 0
    inflow = F.coalesce(F.col("share") * F.col("n"), F.lit(0.0))
    kept = F.when(own, F.col("residual")).otherwise((1 - reset) * inflow)
    summed = [
        F.max(F.when(own, F.col("rank"))).alias("rank"),
        F.sum(kept).alias("residual"),
        F.max("out_degree").alias("out_degree"),
        F.max("splits").alias("splits"),
    ]

    def next_state(state: DataFrame) -> DataFrame:
        joined = state.select(*sends).join(moves.frame, ["src", "part"])
        return joined.groupBy(F.col("dst").alias("domain")).agg(*summed)

    return next_state
