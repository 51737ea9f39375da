"""Benchmark decontamination by a generalised suffix automaton.

The automaton of the normalised test items has a state for each class of word
sequences that end at the same places of the items. Documents are streamed
through it word by word: it keeps the longest sequence that ends at the word and
occurs in an item. Where that is as long as a window, or holds the whole of a
shorter item, its words are hit. Hits make spans, which are removed; documents
with too large a share of hits go.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import new_folder, stored
from .shipping import ship

WINDOW = 10  # words of an item that count as a leak; shorter items count whole
COVERAGE = 0.5  # share of hit words beyond which a document goes
BLOCK_WORDS = 200_000  # of the items in one automaton, about; bounds its broadcast
PIECE_WORDS = 10_000  # of an item in one piece; pieces overlap by a window less one
CHUNK = 1 << 20  # bytes of a text that are split into words at once

# Words are what is left of a text in UTF-8 when A-Z are lower-cased and all
# ASCII but a-z and 0-9 is blank.
_BLANKED = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str) -> Iterator[list[bytes]]:
    """Normalised words of a text, a chunk at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(_BLANKED)
    start = 0
    while start < len(data):
        end = start + CHUNK
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def pieces_of(words: list[bytes], window: int = WINDOW) -> Iterator[list[bytes]]:
    """Pieces of PIECE_WORDS words with the same windows as the whole."""
    step = PIECE_WORDS - window + 1
    for start in range(0, max(1, len(words) - window + 1), step):
        yield words[start : start + PIECE_WORDS]


# --- the automaton -------------------------------------------------------------------


@dataclass
class Automaton:
    """States are numbers; 0 is the empty sequence."""

    window: int
    vocabulary: dict[bytes, int]  # numbers of the words, from 1
    shortest: int  # words of the shortest window
    steps: dict[int, int]  # state * width + word: next state
    link: list[int]  # state of the longest sequence in another class
    length: list[int]  # of a state's longest sequence
    tail: list[int]  # state of the last `window` words, where there are so many
    whole: list[int]  # nearest state, itself or along the links, that is a short item
    items: dict[int, list[str]] = field(repr=False)  # of window states and short items

    def spans(self, chunks: Iterable[list[bytes]]) -> tuple[int, list[list[int]], set[int]]:
        """(words, spans [start, end) of hit words, states that were met).

        Words outside the vocabulary set the automaton back; runs of known words
        too short for any window are passed over.
        """
        steps, link, length, tail, whole = self.steps, self.link, self.length, self.tail, self.whole
        width, window = len(self.vocabulary) + 1, self.window
        spans: list[list[int]] = []
        met: set[int] = set()
        total = state = matched = 0

        def hit(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, end])

        for words in chunks:
            ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
            known = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
            for first, end in known.reshape(-1, 2).tolist():
                if first:
                    state = matched = 0
                # A run at the end of a chunk goes on in the next.
                if not state and end < len(words) and end - first < self.shortest:
                    continue
                for at, word in enumerate(ids[first:end].tolist(), total + first + 1):
                    to = steps.get(state * width + word)
                    while to is None and state:
                        state = link[state]
                        matched = length[state]
                        to = steps.get(state * width + word)
                    if to is None:
                        continue
                    state = to
                    matched += 1
                    if matched >= window:
                        met.add(tail[state])
                        hit(at - matched, at)
                    near = whole[state if length[state] <= matched else link[state]]
                    if near:
                        hit(at - length[near], at)
                    while near:
                        met.add(near)
                        near = whole[link[near]]
                if end < len(words):
                    state = matched = 0
            if len(words) and not ids[-1]:
                state = matched = 0
            total += len(words)
        return total, spans, met

    def found(self, met: Iterable[int]) -> set[str]:
        """Items with a window among the states that were met."""
        return {item for state in met for item in self.items[state]}


def build(items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> Automaton:
    """Automaton of (item, words); an item may come in pieces, in any order."""
    items = [(item, words) for item, words in items if words]
    vocabulary: dict[bytes, int] = {}
    for _, words in items:
        for word in words:
            vocabulary.setdefault(word, len(vocabulary) + 1)
    width = len(vocabulary) + 1
    after: list[dict[int, int]] = [{}]  # steps by state
    link, length = [-1], [0]

    def split(state: int, word: int) -> int:
        """The step's target as a state of its own for this length."""
        to = after[state][word]
        if length[to] == length[state] + 1:
            return to
        new = len(after)
        after.append(dict(after[to]))
        link.append(link[to])
        length.append(length[state] + 1)
        link[to] = new
        while state >= 0 and after[state].get(word) == to:
            after[state][word] = new
            state = link[state]
        return new

    for _, words in items:
        last = 0
        for word in map(vocabulary.__getitem__, words):
            if word in after[last]:
                last = split(last, word)
                continue
            new = len(after)
            after.append({})
            link.append(0)
            length.append(length[last] + 1)
            state, last = last, new
            while state >= 0 and word not in after[state]:
                after[state][word] = new
                state = link[state]
            if state >= 0:
                link[new] = split(state, word)

    tail = [0] * len(after)
    order = sorted(range(1, len(after)), key=length.__getitem__)
    for state in order:  # shorter ones first
        if length[state] >= window:
            tail[state] = tail[link[state]] or state
    short: set[int] = set()
    found: dict[int, set[str]] = {}
    for item, words in items:
        state = 0
        for n, word in enumerate(words, 1):
            state = after[state][vocabulary[word]]
            if n >= window:
                found.setdefault(tail[state], set()).add(item)
        if len(words) < window:
            short.add(state)
            found.setdefault(state, set()).add(item)
    whole = [0] * len(after)
    for state in order:
        whole[state] = state if state in short else whole[link[state]]
    steps = {s * width + w: to for s, own in enumerate(after) for w, to in own.items()}
    shortest = min((min(len(words), window) for _, words in items), default=window)
    names = {state: sorted(own - {None}) for state, own in found.items()}
    return Automaton(window, vocabulary, shortest, steps, link, length, tail, whole, names)


# --- as Spark jobs -------------------------------------------------------------------

_SPANS = "array<struct<start: long, end: long>>"


def _merged(spans: list[list[int]], more: list[dict]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted([*spans, *([s["start"], s["end"]] for s in more)]):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _matcher(automaton, columns: list[str]):
    """Adds what one block of the items finds to _words, _spans and _items."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = automaton.value
        for batch in batches:
            totals, offsets, starts, ends, names = [], [0], [], [], []
            earlier = zip(batch["_spans"].to_pylist(), batch["_items"].to_pylist(), strict=True)
            for text, (spans_before, items_before) in zip(batch["text"], earlier, strict=True):
                total, spans, met = known.spans(words_of(text.as_py() or ""))
                if spans_before:
                    spans = _merged(spans, spans_before)
                totals.append(total)
                starts += [s for s, _ in spans]
                ends += [e for _, e in spans]
                offsets.append(len(starts))
                names.append(sorted(known.found(met) | set(items_before)))
            spans = pa.StructArray.from_arrays(
                [pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["start", "end"]
            )
            new = {
                "_words": pa.array(totals, pa.int64()),
                "_spans": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
                "_items": pa.array(names, pa.list_(pa.string())),
            }
            yield pa.record_batch([new[c] if c in new else batch[c] for c in columns], columns)

    return match


def _split(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = [w for chunk in words_of(text) for w in chunk]
            if words:
                rows += [(item, piece) for piece in pieces_of(words, window)]
        items, pieces = zip(*rows, strict=True) if rows else ((), ())
        yield pa.record_batch(
            [
                pa.array(items, pa.string()),
                pa.array([b" ".join(p) for p in pieces], pa.binary()),
                pa.array([len(p) for p in pieces], pa.int64()),
            ],
            ["item", "piece", "n"],
        )


def matched(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    keep: Sequence[str] = (),
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The columns `keep` of `docs` in a struct `doc`, the number of its text's
    `_words`, the `_spans` [start, end) of words that are hit, and the `_items`
    found, as sorted strings; with "text" in `keep` also `text` beside `doc`.

    Items are cut into pieces and dealt to blocks of about `block_words` words.
    Each block is one automaton, of bounded size, which is broadcast. Documents
    pass through each block; with the usual single block nothing is shuffled or
    written. Between blocks the rows are written to the shared folder.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = benchmark.where("text is not null").select(F.col("item_id").cast("string"), "text")
    pieces = stored(
        texts.distinct().mapInArrow(lambda b: _split(b, window), "item string, piece binary, n long"),
        new_folder(spark, "benchmark"),
    )
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("piece", "item"), F.lit(blocks))
    table = docs.select(
        F.struct(*[c for c in keep if c != "text"]).alias("doc"),
        "text",
        F.lit(0).cast("long").alias("_words"),
        F.array().cast(_SPANS).alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
    )
    for number in range(blocks):
        rows = pieces.where(block == number).select("item", "piece").toLocalIterator()
        automaton = build(((r["item"], bytes(r["piece"]).split()) for r in rows), window)
        last = number + 1 == blocks
        columns = [c for c in table.columns if c != "text" or "text" in keep or not last]
        schema = T.StructType([T.StructField(c, table.schema[c].dataType) for c in columns])
        found = _matcher(spark.sparkContext.broadcast(automaton), columns)
        table = table.mapInArrow(found, schema)
        if not last:
            table = stored(table, new_folder(spark, "decontamination"))
    return table


def without_spans(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the spans of words, and the spans in code points, from
    the first to the last word of each."""
    places, kept, last = [], [], 0
    marks = iter(spans)
    start, end = next(marks, (None, None))
    for number, word in enumerate(_WORD.finditer(text)):
        if start is None:
            break
        if number == start:
            places.append((word.start(), 0))
        if number == end - 1:
            places[-1] = (places[-1][0], word.end())
            start, end = next(marks, (None, None))
    for first, after in places:
        kept.append(text[last:first])
        last = after
    return "".join([*kept, text[last:]]), places


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the spans of words out of the text, and gives them in code points."""
    for batch in batches:
        texts, spans = [], []
        for text, own in zip(batch["text"].to_pylist(), batch["_spans"].to_pylist(), strict=True):
            if own:
                text, places = without_spans(text, [(s["start"], s["end"]) for s in own])
                own = [{"start": start, "end": end} for start, end in places]
            texts.append(text)
            spans.append(own)
        new = {
            "text": pa.array(texts, pa.string()),
            "_spans": pa.array(spans, batch.schema.field("_spans").type),
        }
        names = batch.schema.names
        yield pa.record_batch([new[c] if c in new else batch[c] for c in names], names)


def _hit() -> Column:
    return F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) for every row of
    `docs`.

    A window is `window` consecutive words of an item, or a shorter item as a
    whole; n_hit counts the words inside any occurrence of one, n_items the
    items with occurring windows, `items` lists their ids as sorted strings. A
    null text has no words. An item without an id hits words but is in no list;
    one without words hits nothing. Repeated rows give repeated rows.
    """
    hit = _hit()
    return matched(docs, benchmark, window, ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"),
        F.col("_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.col("_items").alias("items"),
        (hit > 0).alias("contaminated"),
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE
) -> DataFrame:
    """The rows of `docs` as struct `doc`, the leaked spans taken out of its
    text, and those `spans` in code points of the old text.

    Documents of which more than `coverage` of the words are hit go whole.
    """
    table = matched(docs, benchmark, window, docs.columns)
    table = table.where(_hit() <= F.lit(coverage) * F.col("_words"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in table.schema])
    table = table.mapInArrow(_clean, schema)
    doc = F.struct(*[F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])
    return table.select(doc.alias("doc"), F.col("_spans").alias("spans"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`contamination` with the digest of the item list in its place."""
    found = contamination(docs, benchmark)
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")
