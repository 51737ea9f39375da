"""Merkle manifest of a table: digests, proofs and roots by time-forward processing.

Rows are the leaves of one tree of ARITY a group; the subroots of the groups are
the leaves of a last tree. A node's label is its level and its place in it, so
children come before their parents. Digests travel as messages to the label of
the parent in a priority queue: a task sweeps the labels of a block of ARITY **
LEVELS neighbours upwards, and what goes past a block is a row of a stored table
that the next pass sorts by label. The queue is external in that sense: no task
holds more of it than a block. A reversed sweep, from the last pass to the
first, sends each node the proof suffix of its parent, down to the leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.places import placed
from ..storage import new_folder, stored
from .shipping import ship

ARITY = 3
LEVELS = 4  # a block has ARITY ** LEVELS nodes at most
_BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PROOF = "array<struct<before: string, after: string>>"
_NODE = ["grp", "pos", "digest", "n"]


def leaf_digest(*fields: Column | str) -> Column:
    """Hexadecimal SHA-256 of the fields one after the other, each as "-" if
    null, else as its length in UTF-8 bytes, ":" and its value."""

    def field(x: Column) -> Column:
        value = x.cast("string")
        length = F.octet_length(value).cast("string")
        return F.coalesce(F.concat(length, F.lit(":"), value), F.lit("-"))

    columns = [F.col(x) if isinstance(x, str) else x for x in fields]
    return F.sha2(F.concat(*map(field, columns)), 256)


def folded(leaf: Column | str, proof: Column | str) -> Column:
    """Root that a leaf and a proof lead to."""
    leaf, proof = (F.col(x) if isinstance(x, str) else x for x in (leaf, proof))
    return F.aggregate(
        proof, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256)
    )


def proof_digest(proof: Column | str) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    texts = F.transform(proof, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(texts, ""), 256)


# --- sweeps over one block ---------------------------------------------------------


def _parent(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels above n nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def sweep_up(digests: list[str], levels: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """Digest of the block's top, and the children's digests of each label.

    The queue hands out messages by label, (level, place), then by child.
    """
    queue = [(1, place // ARITY, place % ARITY, d) for place, d in enumerate(digests)]
    heapq.heapify(queue)
    children: dict[tuple[int, int], list[str]] = {}
    top = digests[0]
    while levels and queue:
        level, place = queue[0][:2]
        got = []
        while queue and queue[0][:2] == (level, place):
            got.append(heapq.heappop(queue)[3])
        children[level, place] = got
        top = _parent(got)
        if level < levels:
            heapq.heappush(queue, (level + 1, place // ARITY, place % ARITY, top))
    return top, children


def sweep_down(children: dict[tuple[int, int], list[str]], levels: int) -> Iterator[tuple[int, tuple]]:
    """(place, proof within the block) of each leaf; proofs are linked tuples
    (before, after, rest) that share their suffixes.

    The reversed order of labels: the greatest first.
    """
    queue: list[tuple[int, int, tuple | None]] = [(-levels, 0, None)]
    while queue:
        level, place, rest = heapq.heappop(queue)
        level, place = -level, -place
        if not level:
            yield place, rest
            continue
        got = children[level, place]
        for i in range(len(got)):
            step = ("".join(got[:i]), "".join(got[i + 1 :]), rest)
            heapq.heappush(queue, (1 - level, -(place * ARITY + i), step))


def _lifted(n: int) -> int:
    """Levels that a block of a group of n nodes is lifted in one pass."""
    return LEVELS if n > _BLOCK else levels_of(n)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come sorted by grp and block, cut where a block ends."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, i: int) -> tuple:
        return batch["grp"][i].as_py(), batch["block"][i].as_py()

    for batch in batches:
        if not batch.num_rows:
            continue
        last, low, high = key(batch, -1), 0, batch.num_rows - 1
        while low < high:  # the first row of the last block
            middle = (low + high) // 2
            low, high = (low, middle) if key(batch, middle) == last else (middle + 1, high)
        if low:
            yield pa.Table.from_batches([*held, batch.slice(0, low)])
            held = []
        elif held and key(held[-1], -1) != last:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(low))
    if held:
        yield pa.Table.from_batches(held)


def _rows(table: pa.Table, *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """((grp, block), rows of the named columns) of each block."""
    columns = [table[c].to_pylist() for c in ("grp", "block", *names)]
    for key, rows in groupby(zip(*columns, strict=True), lambda row: row[:2]):
        yield key, [row[2:] for row in rows]


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, sorted by pos, to their tops."""
    for table in _whole_blocks(batches):
        tops = []
        for (grp, block), rows in _rows(table, "digest", "n"):
            n = rows[0][1]
            top, _ = sweep_up([digest for digest, _ in rows], _lifted(n))
            tops.append((grp, block, top, -(-n // _BLOCK)))
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = zip(zip(*tops, strict=True), kinds, strict=True)
        yield pa.record_batch([pa.array(c, kind) for c, kind in columns], _NODE)


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, their parent first with pos null, to their nodes with the whole
    proofs and the parent's subroot. Other columns pass through."""
    for table in _whole_blocks(batches):
        offsets, before, after, subroots = [0], [], [], []
        for _, rows in _rows(table, "digest", "n", "proof", "subroot"):
            (_, _, suffix, subroot), *nodes = rows
            if not nodes:  # a manifest without rows
                continue
            levels = _lifted(nodes[0][1])
            _, children = sweep_up([node[0] for node in nodes], levels)
            for _, step in sorted(sweep_down(children, levels)):
                while step is not None:
                    before.append(step[0])
                    after.append(step[1])
                    step = step[2]
                before += [s["before"] for s in suffix]
                after += [s["after"] for s in suffix]
                offsets.append(len(before))
                subroots.append(subroot)
        steps = pa.StructArray.from_arrays(
            [pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"]
        )
        proof = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)
        nodes = table.filter(table["pos"].is_valid()).drop_columns(["block", "proof", "subroot"])
        nodes = nodes.append_column("proof", proof)
        nodes = nodes.append_column("subroot", pa.array(subroots, pa.string()))
        yield from nodes.combine_chunks().to_batches()


# --- passes ------------------------------------------------------------------------


def _swept(
    rows: DataFrame, sweep: Callable, columns: list[str], like: DataFrame
) -> DataFrame:
    """Whole blocks side by side in a task, sorted by label, through a sweep."""
    schema = like.select(*columns).schema
    for field in schema:
        field.nullable = True
    blocks = rows.repartition("grp", "block")
    return blocks.sortWithinPartitions("grp", "block", "pos").mapInArrow(sweep, schema)


def _block() -> Column:
    return F.floor(F.col("pos") / _BLOCK)


def _climb(nodes: DataFrame, folder: str) -> list[DataFrame]:
    """The stored node tables of all passes, `nodes` first; the last has one
    node a group."""
    passes = [nodes]
    while (passes[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rows = passes[-1].select(*_NODE, _block().alias("block"))
        tops = _swept(rows, _up, _NODE, nodes)
        passes.append(stored(tops, f"{folder}-{len(passes)}"))
    return passes


def _descend(passes: list[DataFrame], tops: DataFrame, folder: str) -> DataFrame:
    """The nodes of the first pass with `proof` and `subroot`; `tops` has them
    (grp, proof, subroot) for the one node each group ends in."""
    above = tops.withColumn("pos", F.lit(0).cast("long"))
    for number, nodes in reversed(list(enumerate(passes[:-1] or passes))):
        parents = above.select("grp", F.col("pos").alias("block"), "proof", "subroot")
        rows = nodes.withColumn("block", _block())
        rows = rows.unionByName(parents, allowMissingColumns=True)
        above = _swept(rows, _down, [*nodes.columns, "proof", "subroot"], rows)
        if number:
            above = stored(above, f"{folder}-{number}")
    return above


def proofs(
    rows: DataFrame, group: str, order: list[str], digest: str
) -> tuple[DataFrame, str | None]:
    """`rows` with `subroot` and `proof`, and the root of the manifest.

    The leaves are the digests in the column `digest`, in each `group` (a string
    column) in the order of the columns `order`, nulls first, then of the digest.
    While several nodes of a group remain, each ARITY consecutive ones become
    their SHA-256; the last run may be shorter, even one node. What remains are
    the subroots; they ascend bytewise by group, null first, and become the root
    in the same way. `proof` lists, from the leaf to the root, the texts of the
    siblings before and after the node. Repeated rows are leaves of their own.
    Columns of any name pass through. Without rows the root is None.
    """
    spark = rows.sparkSession
    ship(spark)
    folder = new_folder(spark, "merkle")
    # "n" sorts before "s", so a null group comes first and is still a key.
    key = F.coalesce(F.concat(F.lit("s"), F.col(group)), F.lit("n")).alias("grp")
    by = [F.col(c).alias(f"_by{i}") for i, c in enumerate(order)]
    names = [f"_by{i}" for i in range(len(order))]
    leaves = rows.select(key, F.col(digest).alias("digest"), *by, F.struct("*").alias("row"))
    leaves = placed(leaves, "grp", [F.col(c) for c in (*names, "digest")], f"{folder}/leaves").drop(*names)
    passes = _climb(leaves, f"{folder}/up")

    subroots = passes[-1].select(F.lit("").alias("grp"), "digest", F.col("grp").alias("of"))
    subroots = placed(subroots, "grp", [F.col("of")], f"{folder}/subroots")
    tree = _climb(subroots, f"{folder}/tree")
    root = tree[-1].first()
    whole = spark.range(1).select(
        F.lit("").alias("grp"), F.array().cast(_PROOF).alias("proof"), F.lit("").alias("subroot")
    )
    down = _descend(tree, whole, f"{folder}/tree-down")
    tops = down.select(F.col("of").alias("grp"), "proof", F.col("digest").alias("subroot"))
    found = _descend(passes, stored(tops, f"{folder}/tops"), f"{folder}/down")
    return found.select("row.*", "subroot", "proof"), root["digest"] if root else None


def manifest(docs: DataFrame, **more: Column) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof) for every row of `docs`, and
    the columns given in `more`.

    A leaf is the digest of FIELDS, null ones as "-"; a tree a source. Rows
    without a doc_id come first in their source, those without a source form
    one of their own. Repeated rows are leaves of their own, one after the
    other. No rows give no rows.
    """
    leaves = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        leaf_digest(*FIELDS).alias("leaf"),
        *[column.alias(name) for name, column in more.items()],
    )
    found, root = proofs(leaves, "source", ["doc_id"], "leaf")
    return found.select(
        "doc_id", "source", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof", *more
    )


def verified(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for
    every row of `docs`.

    Of documents whose id has an even CRC-32 (not those without an id) the line
    ends are taken out of the text after the manifest is made. folded_root is
    what the leaf as it is then leads to with the proof of the manifest.
    """
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(tampered, F.replace("text", F.lit("\n"))).otherwise(F.col("text"))
    now = leaf_digest(*FIELDS[:-1], text)
    return (
        manifest(docs, now=now)
        .withColumn("folded_root", folded("now", "proof"))
        .select(
            "doc_id",
            "leaf",
            "subroot",
            "root",
            proof_digest("proof").alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )
