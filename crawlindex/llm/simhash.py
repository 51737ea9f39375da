"""Near-duplicate documents by SimHash and anchor-point covering.

A fingerprint is the majority, bit by bit, of the XXH64 hashes of a document's
word shingles. Links are found with a covering code: the 46 low bits are two
words of the perfect (23, 12) Golay code, whose code words are the anchors. Any
word is within the covering radius, 3, of just one code word. Its fingerprint
has its home there, and is replicated to every anchor within covering radius
plus threshold that can be the home of a fingerprint within the threshold. Two
linked fingerprints so meet at the home of either. Fingerprints are compared
in full per anchor; the 18 bits outside the code only tell there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import new_folder, stored
from .components import components
from .shipping import ship

SHINGLE = 3
SEED = 42
THRESHOLD = 2  # the code tables below are built for it

_GOLAY = 0b110001110101  # generator polynomial of the (23, 12) code
_LENGTH = 23
_PAIRWISE = 64  # larger groups are compared by shared one-bit neighbours
_KEYS = 4_000_000  # neighbours held at once


# --- fingerprints ------------------------------------------------------------


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """Of UTF-8 text: lower-cased A-Z, words between ASCII white space.

    With fewer words the whole sequence is the one shingle; none gives zero.
    """
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        tokens = [b" ".join(tokens)]
        words = 1
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    n = len(tokens) - words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 4096):
        block = hashes[start : start + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.int64)[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    raw = texts.cast(pa.large_binary())
    return pa.array((fingerprint(x.as_py() or b"") for x in raw), pa.int64())


def simhash(text: str | Column) -> Column:
    """64-bit fingerprint as a signed number. Null text counts as empty: zero."""
    return _fingerprints(F.col(text) if isinstance(text, str) else text)


# --- the covering code ---------------------------------------------------------


@cache
def _code() -> tuple:
    """Syndrome tables, the error each syndrome stands for, and the moves.

    moves[c] lists, for each syndrome, the other anchors (as differences from
    the home) that become the home after c changed bits but not after fewer.
    """
    of_bit = []
    for i in range(_LENGTH):
        rest = 1 << i
        for shift in range(_LENGTH - 12, -1, -1):
            if rest >> (shift + 11) & 1:
                rest ^= _GOLAY << shift
        of_bit.append(rest)
    low = np.zeros(1 << 12, np.int32)
    high = np.zeros(1 << 11, np.int32)
    for table, bits in ((low, of_bit[:12]), (high, of_bit[12:])):
        for i, syndrome in enumerate(bits):
            table[1 << i : 2 << i] = table[: 1 << i] ^ syndrome
    changes = [((), 0)] + [
        (bits, sum(1 << b for b in bits)) for k in (1, 2, 3) for bits in combinations(range(_LENGTH), k)
    ]
    error = np.zeros(1 << 11, np.int32)
    for _, word in changes:
        error[low[word & 4095] ^ high[word >> 12]] = word
    moves = [([0] * 2049, []) for _ in range(THRESHOLD + 1)]
    small = [(len(bits), word, int(low[word & 4095] ^ high[word >> 12])) for bits, word in changes if len(bits) <= THRESHOLD]
    for syndrome in range(1 << 11):
        cost: dict[int, int] = {}
        for k, word, change in small:
            to = word ^ int(error[syndrome ^ change]) ^ int(error[syndrome])
            cost.setdefault(to, k)
        for k, (starts, found) in enumerate(moves):
            found += [to for to, c in cost.items() if c == k]
            starts[syndrome + 1] = len(found)
    packed = [(np.array(s, np.int64), np.array(f, np.int32)) for s, f in moves]
    return low, high, error, packed


def _anchors(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, anchors, home) for the homes, then for the replicas by class."""
    low, high, error, moves = _code()
    homes, syndromes = [], []
    for shift in (0, _LENGTH):
        word = (fps >> np.uint64(shift)).astype(np.int64) & ((1 << _LENGTH) - 1)
        syndrome = low[word & 4095] ^ high[word >> 12]
        homes.append(word ^ error[syndrome])
        syndromes.append(syndrome)
    for first in range(THRESHOLD + 1):
        for second in range(THRESHOLD + 1 - first):
            (s1, to1), (s2, to2) = moves[first], moves[second]
            a, b = s1[syndromes[0]], s2[syndromes[1]]
            na, nb = s1[syndromes[0] + 1] - a, s2[syndromes[1] + 1] - b
            each = na * nb
            rows = np.repeat(np.arange(len(fps)), each)
            place = np.arange(len(rows)) - np.repeat(np.cumsum(each) - each, each)
            one = homes[0][rows] ^ to1[a[rows] + place // nb[rows]]
            two = homes[1][rows] ^ to2[b[rows] + place % nb[rows]]
            # Twelve bits in a row tell the words of a cyclic code apart.
            yield rows, ((one >> 11) << 12 | two >> 11).astype(np.int32), first + second == 0


_AT_ANCHORS = "anchor int, fp long, home boolean"


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for start in range(0, len(every), 4096):
            fps = every[start : start + 4096]
            for rows, anchors, home in _anchors(fps):
                yield pa.record_batch(
                    [
                        pa.array(anchors),
                        pa.array(fps[rows].view(np.int64)),
                        pa.array(np.full(len(rows), home)),
                    ],
                    ["anchor", "fp", "home"],
                )


# --- comparison ------------------------------------------------------------------


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes over links a-b."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        after = root.copy()
        for side in (a, b):
            np.minimum.at(after, side, least)
            np.minimum.at(after, root[side], least)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _star(fps_a: np.ndarray, fps_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as one link from each fingerprint to its group's smallest."""
    nodes, at = np.unique(np.concatenate([fps_a, fps_b]), return_inverse=True)
    root = _roots(len(nodes), at[: len(fps_a)], at[len(fps_a) :])
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _large_group(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links of one anchor's many fingerprints, in linear time.

    Two differ in at most two bits just if they share a neighbour at one bit or
    less. Neighbours are sorted in passes, each holding a share of them.
    """
    fps = np.unique(fps)
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    passes = np.uint64(1 + 65 * len(fps) // _KEYS)
    found_a, found_b = [], []
    for turn in range(int(passes)):
        keys, owners = [], []
        for flip in flips:
            key = fps ^ flip
            mixed = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            mine = np.flatnonzero(mixed % passes == np.uint64(turn))
            keys.append(key[mine])
            owners.append(mine)
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        same = np.flatnonzero(key[1:] == key[:-1])
        a, b = _star(owner[same], owner[same + 1])
        found_a.append(a)
        found_b.append(b)
    return fps[np.concatenate(found_a)], fps[np.concatenate(found_b)]


def _groups(anchor: np.ndarray, fps: np.ndarray, home: np.ndarray):
    """Star links of whole groups, sorted by anchor."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    homes = np.add.reduceat(home, starts, dtype=np.int64)
    a, b = [], []
    small = np.repeat((sizes > 1) & (sizes <= _PAIRWISE) & (homes > 0), sizes)
    at, f, h = anchor[small], fps[small], home[small]
    for k in range(1, _PAIRWISE):
        near = np.flatnonzero(at[k:] == at[:-k])
        if not len(near):
            break
        near = near[h[near] | h[near + k]]
        near = near[np.bitwise_count(f[near] ^ f[near + k]) <= THRESHOLD]
        a.append(f[near])
        b.append(f[near + k])
    for i in np.flatnonzero((sizes > _PAIRWISE) & (homes > 0)):
        one, two = _large_group(fps[starts[i] : starts[i] + sizes[i]])
        a.append(one)
        b.append(two)
    if not a:
        return a, b
    return _star(np.concatenate(a), np.concatenate(b))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; a group may span batches."""
    held: list[tuple] = []

    def out(parts):
        if not parts:
            return
        a, b = _groups(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        if len(a):
            yield pa.record_batch(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["src", "dst"]
            )

    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, fps, home = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        fps = fps.view(np.uint64)
        last = int(np.searchsorted(anchor, anchor[-1]))
        if last:
            yield from out([*held, (anchor[:last], fps[:last], home[:last])])
            held = []
        elif held and held[-1][0][-1] != anchor[0]:
            yield from out(held)
            held = []
        held.append((anchor[last:], fps[last:], home[last:]))
    yield from out(held)


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """Links (src, dst) that connect all of `fingerprints` (fp long, distinct)
    that differ in at most two bits: not all pairs, but the same components."""
    at_anchors = fingerprints.select("fp").mapInArrow(_replicate, _AT_ANCHORS)
    return (
        at_anchors.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_compare, "src long, dst long")
        .distinct()
    )


def _groups_of(marked: DataFrame, order: Column) -> DataFrame:
    """(fp, component_id) of the fingerprints of `marked`: the smallest `order`
    of the rows reachable over links of at most two differing bits."""
    first = stored(
        marked.groupBy("fp").agg(F.min(order).alias("first")),
        new_folder(marked.sparkSession, "simhash"),
    )
    linked = components(fingerprint_links(first))
    linked = linked.withColumnRenamed("node", "fp").join(first, "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("smallest"))
    linked = linked.join(smallest, "root").select("fp", "smallest")
    return first.join(linked, "fp", "left").select(
        "fp", F.coalesce("smallest", "first").alias("component_id")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`.

    component_id is the smallest doc_id of the documents reachable over links
    of at most two differing bits. Null and empty texts have fingerprint zero
    and are linked like others. Repeated rows give repeated rows; a null doc_id
    stays null and is never a component_id unless its group has no other.
    """
    spark = docs.sparkSession
    ship(spark)
    marked = stored(
        docs.select("doc_id", simhash("text").alias("fp")), new_folder(spark, "simhash")
    )
    group = _groups_of(marked, F.col("doc_id"))
    return marked.join(group, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Just one row of each group of near-duplicates, whatever its doc_id: that
    with the smallest doc_id, nulls last, then the smallest digest of the text.
    Which of rows equal in both stays is open."""
    spark = docs.sparkSession
    ship(spark)
    rows = stored(
        docs.select(
            F.struct("*").alias("doc"),
            simhash("text").alias("fp"),
            F.struct(
                F.col("doc_id").isNull().alias("no_id"),
                "doc_id",
                F.sha2("text", 256).alias("digest"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("place"),
        ),
        new_folder(spark, "simhash"),
    )
    groups = _groups_of(rows.select("fp", "place"), F.col("place"))
    kept = groups.select(F.col("component_id.row").alias("row")).distinct()
    # The row numbers are those stored, so no row is met twice.
    return rows.withColumn("row", F.col("place.row")).join(kept, "row", "left_semi").select("doc.*")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest
    doc_id, once even if its row is repeated. Groups without any doc_id go;
    `one_of_each` keeps one of them too."""
    return one_of_each(docs).where(F.col("doc_id").isNotNull())
