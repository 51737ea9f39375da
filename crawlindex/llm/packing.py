"""Packing documents into training sequences, shortest pack first.

Documents are cut into full sequences and one rest. Only the histogram of rest
lengths, a few thousand numbers, goes to the driver. There lengths are placed
longest first, each into the pattern with most room left, with counts of how
often each pattern occurs. Rests find their place by their rank in their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import new_folder, stored
from .bpe import encoded

LENGTH = 2048
END_ID = 1
RANKED_ROWS = 200_000  # rests of one length ranked in a task, about

_PIECE = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """(count, lengths) of the packs that hold histogram[n] rests of length n.

    Longest lengths first, each into the shortest pack it fits in. What fits in
    none opens packs of as many equal rests as they hold, as only shorter ones
    come after. At most three patterns are added for each length, so their
    number is bounded by `size`.
    """
    by_room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, found in by_room.items() if found), default=-1)
            if room < length:
                full, over = divmod(left, size // length)
                for count, times in ((full, size // length), (min(over, 1), over)):
                    if count:
                        by_room[size - times * length].append((count, [length] * times))
                break
            count, pattern = by_room[room].pop()
            placed = min(count, left)
            if count > placed:
                by_room[room].append((count - placed, pattern))
            by_room[room - length].append((placed, [*pattern, length]))
            left -= placed
    return [pack for room in sorted(by_room) for pack in by_room[room]]


def slots(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, count, sequence, offset, times): rests of ranks first ..
    first + count * times - 1 in their length go to `count` sequences from
    `sequence` on, `times` in each, one after the other from `offset`."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, pattern in patterns(histogram, size):
        offset = 0
        for length in dict.fromkeys(pattern):
            times = pattern.count(length)
            rows.append((length, used[length], count, sequence, offset, times))
            used[length] += count * times
            offset += length * times
        sequence += count
    return rows


def _pieces_of(size: int, end_id: int, ids: bool):
    kind = T.StructType([*_PIECE, T.StructField("ids", T.BinaryType())]) if ids else _PIECE
    fields = [(name, pa.int64()) for name in _PIECE.names]
    with_ids = [("ids", pa.binary())] if ids else []

    @F.arrow_udf(T.ArrayType(kind))
    def pieces(column: pa.Array) -> pa.Array:
        end = np.array([end_id], "<u4").tobytes()
        out = []
        for raw in column:
            whole = raw.as_py() + end
            out.append(
                [
                    {
                        "start": at // 4,
                        "length": len(part) // 4,
                        "ids_crc32": zlib.crc32(part),
                    }
                    | ({"ids": part} if ids else {})
                    for at in range(0, len(whole), 4 * size)
                    for part in (whole[at : at + 4 * size],)
                ]
            )
        return pa.array(out, pa.list_(pa.struct(fields + with_ids)))

    return pieces


def packed(
    docs: DataFrame, size: int = LENGTH, end_id: int = END_ID, ids: bool = False
) -> DataFrame:
    """One row per piece of every document: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset; and with `ids` the piece itself, its ids as
    little-endian unsigned 32-bit integers. Places are found without them.

    A document's ids end in `end_id`; null and empty texts have that id alone.
    Documents longer than `size` are cut into full sequences and a rest.
    Repeated rows are packed as documents of their own, null ids too. An empty
    table gives no rows. Which of equally long rests goes where follows
    doc_id, start and checksum, then stays open between equal rows only.
    """
    spark = docs.sparkSession
    cut = (
        encoded(docs)
        .select(
            "doc_id",
            (F.length("ids") / 4 + 1).cast("long").alias("doc_tokens"),
            F.explode(_pieces_of(size, end_id, ids)("ids")).alias("p"),
        )
        .select("doc_id", "doc_tokens", "p.*")
    )
    numbered = ["_row"] if ids else []
    if ids:
        cut = cut.withColumn("_row", F.monotonically_increasing_id())
    cut = whole = stored(cut, new_folder(spark, "packing"))
    cut = cut.drop("ids")
    # Rests of one length are ranked in shares, so that no length is one task.
    shares = 1 + cut.count() // RANKED_ROWS
    share = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shares)).alias("share")
    sizes = cut.select("length", share).groupBy("length", "share").agg(F.count("*").alias("n"))
    sizes = stored(sizes, new_folder(spark, "packing"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(histogram, size)  # the histogram has `size` lengths at most
    before = sizes.select(
        "length",
        "share",
        F.expr(
            "sum(n) OVER (PARTITION BY length ORDER BY share"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ).alias("before"),
    )
    in_share = F.expr(
        "row_number() OVER (PARTITION BY length, share"
        " ORDER BY doc_id, start, ids_crc32, doc_tokens) - 1"
    )
    ranked = (
        cut.select("*", share)
        .withColumn("in_share", in_share)
        .join(before, ["length", "share"])
        .withColumn("rank", F.col("in_share") + F.coalesce("before", F.lit(0)))
    )
    by_length: dict[int, list] = defaultdict(list)
    for length, *place in places:
        by_length[length].append(place)
    kind = "length long, places array<struct<first:long,count:long,sequence:long,at:long,times:long>>"
    table = spark.createDataFrame(sorted(by_length.items()), kind)
    # Bounded by `size` lengths and their patterns, whatever the data.
    placed = ranked.join(F.broadcast(table), "length")
    place = F.expr(
        "filter(places, p -> rank >= p.first AND rank < p.first + p.count * p.times)[0]"
    )
    found = (
        placed.withColumn("place", place)
        .withColumn("turn", F.col("rank") - F.col("place.first"))
        .select(
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            (F.col("place.sequence") + F.expr("turn % place.count")).alias("sequence_id"),
            (F.col("place.at") + F.expr("turn div place.count") * F.col("length")).alias("offset"),
            *numbered,
        )
    )
    # The row numbers are those stored, so each piece meets its own ids.
    return found.join(whole.select("_row", "ids"), "_row").drop("_row") if ids else found
