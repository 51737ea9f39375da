"""Byte-level BPE encoding and decoding; long texts by tree concatenation.

Texts of at most PIECE characters are encoded whole. Longer ones are cut into
pieces, which are dealt out and encoded in parallel. Neighbours are then joined
in a tree: a window around the join is encoded anew and grown until both sides
agree with it, so that the result is that of the whole text.

The vocabulary is that of the tokenizers file byte_bpe_50k.json, read from its
rank file; the ids are the same (tests compare them with the tokenizers library).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import ship

RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
PIECE = 1 << 15  # characters
WINDOW = 64  # bytes of either side at first

# A cut before the white space here is one between words in any context.
_SAFE = re.compile(rb"[!-~](?=[ \n])")


class Codec:
    """Encoder, decoder and token lengths of one vocabulary."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._coder = tiktoken.Encoding(
            "bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
        strings = {i: s for s, i in ranks.items()} | {i: s.encode() for s, i in SPECIAL.items()}
        self._strings = strings
        self.lengths = np.zeros(max(strings) + 1, np.int64)
        for i, s in strings.items():
            self.lengths[i] = len(s)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, special strings included, as 32-bit unsigned."""
        return self._coder.encode_to_numpy(text, allowed_special="all")

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; unknown ids add nothing, broken UTF-8 is replaced."""
        known = map(self._strings.get, ids.tolist())
        return b"".join(s for s in known if s is not None).decode("utf-8", "replace")

    # --- tree concatenation

    def _left_cut(self, text: bytes, ids: np.ndarray, window: int) -> tuple[int, int, bool]:
        """Byte and token place to keep the left side up to, and if it's safe."""
        if len(text) <= 2 * window:
            return 0, 0, True
        start = len(text) - 2 * window
        safe = [m.end() for m in _SAFE.finditer(text, start, len(text) - window)]
        ends = len(text) - np.cumsum(self.lengths[ids[::-1][: 2 * window]])
        if safe:
            kept = int(np.flatnonzero(ends == safe[-1])[0])
            return safe[-1], len(ids) - kept - 1, True
        for k in np.flatnonzero((ends >= start) & (ends <= len(text) - window)):
            at = int(ends[k])
            if text[at] & 0xC0 != 0x80 and text[at] != 0x27:
                return at, len(ids) - int(k) - 1, False
        return -1, -1, False

    def _right_cut(self, text: bytes, ids: np.ndarray, window: int) -> tuple[int, int, bool]:
        if len(text) <= 2 * window:
            return len(text), len(ids), True
        safe = _SAFE.search(text, window, 2 * window)
        ends = np.cumsum(self.lengths[ids[: 2 * window]])
        if safe:
            return safe.end(), int(np.flatnonzero(ends == safe.end())[0]) + 1, True
        for k in np.flatnonzero((ends >= window) & (ends < 2 * window)):
            at = int(ends[k])
            if text[at] & 0xC0 != 0x80 and text[at] != 0x27:
                return at, int(k) + 1, False
        return -1, -1, False

    def join(self, left: tuple[bytes, np.ndarray], right: tuple[bytes, np.ndarray]):
        """(text, ids) of two neighbours.

        Cuts are made before white space that follows a visible ASCII sign,
        where the merges of no word reach over. Inside longer unsplit text they
        are made between two tokens. There a sequence is the encoding just if
        each pair of neighbours is, so the window has to repeat the two tokens
        next to the cut.
        """
        (text, ids), (text_r, ids_r) = left, right
        window = WINDOW
        while True:
            a, ka, safe_a = self._left_cut(text, ids, window)
            b, kb, safe_b = self._right_cut(text_r, ids_r, window)
            if a >= 0 and b >= 0:
                new = self.encode((text[a:] + text_r[:b]).decode())
                same_a = safe_a or (len(new) > 4 and (new[:2] == ids[ka : ka + 2]).all())
                same_b = safe_b or (len(new) > 4 and (new[-2:] == ids_r[kb - 2 : kb]).all())
                if same_a and same_b:
                    return text + text_r, np.concatenate([ids[:ka], new, ids_r[kb:]])
            window *= 2

    def concatenate(self, pieces: list[tuple[bytes, np.ndarray]]) -> np.ndarray:
        """Ids of a text from its encoded pieces, joined as a tree."""
        while len(pieces) > 1:
            paired = zip(pieces[::2], pieces[1::2], strict=False)
            rest = pieces[len(pieces) & ~1 :]
            pieces = [self.join(left, right) for left, right in paired] + rest
        return pieces[0][1]


@cache
def codec(ranks_path: str | None = None) -> Codec:
    """One per worker and vocabulary; by default the installed public file."""
    return Codec(ranks_path or public_tokenizers.path(RANKS))


def _encoder(ranks_path: str | None):
    @F.arrow_udf(T.BinaryType())
    def encode(texts: pa.Array) -> pa.Array:
        coder = codec(ranks_path)
        return pa.array((coder.encode(t.as_py() or "").tobytes() for t in texts), pa.binary())

    return encode


def decoded(ids: str | Column, ranks_path: str | None = None) -> Column:
    """Text of a binary column of little-endian 32-bit ids; null stays null."""

    @F.arrow_udf(T.StringType())
    def decode(column: pa.Array) -> pa.Array:
        coder = codec(ranks_path)
        return pa.array(
            (
                None if not x.is_valid else coder.decode(np.frombuffer(x.as_py(), "<u4"))
                for x in column
            ),
            pa.string(),
        )

    return decode(F.col(ids) if isinstance(ids, str) else ids)


def _cut(piece: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digest", "no", "piece"]
        for batch in batches:
            for digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for start in range(0, len(text), 64 * piece):
                    places = range(start, min(len(text), start + 64 * piece), piece)
                    rows = [(digest, i // piece, text[i : i + piece]) for i in places]
                    columns = map(list, zip(*rows, strict=True))
                    kinds = (pa.string(), pa.int64(), pa.string())
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                    yield pa.record_batch(arrays, names)

    return cut


def _joiner(ranks_path: str | None):
    def join(pieces: pa.Table) -> pa.Table:
        coder = codec(ranks_path)
        rows = pieces.sort_by("no")
        parts = [
            (text.encode(), np.frombuffer(ids, "<u4"))
            for text, ids in zip(
                rows["piece"].to_pylist(), rows["ids"].to_pylist(), strict=True
            )
        ]
        ids = coder.concatenate(parts).astype("<u4").tobytes()
        return pa.table({"digest": rows["digest"][:1], "ids": pa.array([ids], pa.binary())})

    return join


def encoded(
    docs: DataFrame, piece: int = PIECE, ranks_path: str | None = None
) -> DataFrame:
    """(doc_id, ids) for every row of `docs`: ids are the little-endian 32-bit
    ids of the whole text as bytes. Null text counts as empty and has none.
    Repeated rows and null ids give rows of their own.

    Equal long texts are encoded once.
    """
    ship(docs.sparkSession)
    encode = _encoder(ranks_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.where(F.length(text) <= piece).select("doc_id", encode(text).alias("ids"))
    long = docs.where(F.length("text") > piece).select(
        "doc_id", F.sha2("text", 256).alias("digest"), "text"
    )
    pieces = (
        long.select("digest", "text")
        .mapInArrow(_cut(piece), "digest string, no long, piece string")
        .groupBy("digest", "no")
        .agg(F.first("piece").alias("piece"))
        .withColumn("ids", encode("piece"))
    )
    joined = pieces.groupBy("digest").applyInArrow(
        _joiner(ranks_path), "digest string, ids binary"
    )
    return whole.unionByName(
        long.select("doc_id", "digest").join(joined, "digest").select("doc_id", "ids")
    )


def round_trip(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of `docs`."""
    return encoded(docs).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decoded("ids"), 256).alias("decoded_sha256"),
    )
