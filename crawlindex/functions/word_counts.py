"""Words of pages, counted in Arrow batches.

The same words as those of `text.count_words`, which counts with array functions:
there every word of a page passes several interpreted functions. Here the bytes of
many texts are classified at once, words become numbers, and numbers are sorted.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 16 << 20  # of texts that a worker counts at once, about
_ROWS = 100_000  # handed on at once

_SEPARATES, _PUNCTUATION = np.zeros((2, 256), dtype=bool)
_SEPARATES[list(b" \t\n\x0b\f\r|")] = True
_PUNCTUATION[list(string.punctuation.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[list(string.ascii_uppercase.encode())] += 32


def counter(text: str, first: str | None, stop_words: Sequence[str]) -> Callable:
    """For `mapInArrow`: the columns but `text`, and `keyword, keyword_weight`.

    The rows of a slice of the pages come in the order of the column `first`, and
    those of a page by keyword. So the long values of a page, and of all captures
    of it in the slice, lie side by side in files and shuffles.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pages in _slices(batch, text):
                yield from _counted(pages, text, first, stop_words)

    return count


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(batch)]):
        yield batch.slice(start, end - start)


def _counted(
    pages: pa.RecordBatch, text: str, first: str | None, stop_words: Sequence[str]
) -> Iterator[pa.RecordBatch]:
    page, words = _words(pages[text])
    words = words.dictionary_encode()
    known, word = words.dictionary, words.indices.to_numpy()
    stops = pc.is_in(known, value_set=pa.array(stop_words, known.type))
    kept = ~stops.to_numpy(zero_copy_only=False)[word]
    page, word = page[kept], word[kept]
    by_word = pc.sort_indices(known).to_numpy()
    by_page = pc.sort_indices(pages[first]).to_numpy() if first else np.arange(len(pages))
    keys = _places(by_page)[page] * len(known) + _places(by_word)[word]
    keys, weights = np.unique(keys, return_counts=True)
    others = [c for c in pages.schema.names if c != text]
    for at in range(0, len(keys), _ROWS):
        page, word = np.divmod(keys[at : at + _ROWS], len(known))
        columns = [pages[c].take(pa.array(by_page[page])) for c in others]
        columns.append(known.take(pa.array(by_word[word])).cast(pages.schema.field(text).type))
        columns.append(pa.array(weights[at : at + _ROWS], pa.int32()))
        yield pa.record_batch(columns, [*others, "keyword", "keyword_weight"])


def _places(order: np.ndarray) -> np.ndarray:
    places = np.empty(len(order), dtype=np.int64)
    places[order] = np.arange(len(order))
    return places


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Of each word, in order, the place of its text and the word."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    ascii_only = data < 128
    if not ascii_only.all():
        ends = np.concatenate([[0], np.cumsum(ascii_only, dtype=np.int64)])[ends]
        data = data[ascii_only]
    inside = ~_SEPARATES[data]
    # A word begins and ends where a separator or the edge of a text is.
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[ends] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    if not len(start):
        return start, pa.array([], pa.large_string())
    punctuation = _PUNCTUATION[data]
    real = np.logical_or.reduceat(inside & ~punctuation, start)
    start, end = start[real], end[real]
    end = end - punctuation[end - 1]
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[start] += 1
    step[end] -= 1
    letters = _LOWER[data[np.cumsum(step, dtype=np.int8)[:-1].astype(bool)]]
    offsets = np.concatenate([[0], np.cumsum(end - start, dtype=np.int64)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    words = pa.Array.from_buffers(pa.large_string(), len(start), buffers)
    return np.searchsorted(ends, start, side="right") - 1, words
