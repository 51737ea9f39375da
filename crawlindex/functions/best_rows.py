"""The best rows of each query in a task, picked in Arrow batches.

A window sorts all rows of a task before it drops nearly all of them, which spills
where a task has many. Here a task holds a bounded number of rows, and cuts them to
the best of each query as they come in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

HELD_ROWS = 200_000  # until they are cut, about


def best_rows(query: str, k: int, held_rows: int = HELD_ROWS) -> Callable:
    """For `mapInArrow`: of a table with `score` and `uri` all but rows that have k
    better ones of the same query in their task.

    Rows of so many queries that cutting does not help are handed on as they are
    then, so a query may have more than k rows of a task, and never fewer.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= held_rows:
                table = _cut(held, query, k)
                if 2 * len(table) > held_rows:
                    yield from table.to_batches()
                    table = table.slice(0, 0)
                held, n = table.to_batches(), len(table)
        if n:
            yield from _cut(held, query, k).to_batches()

    return kept


def _cut(batches: list[pa.RecordBatch], query: str, k: int) -> pa.Table:
    """The k best rows of each query, in the order of Spark's `score DESC, uri ASC`:
    NaN is the highest score, a missing one the lowest, a missing URI comes first."""
    table = pa.Table.from_batches(batches).combine_chunks()
    number = _column(table, query).dictionary_encode(null_encoding="encode").indices
    number, score, uri = number.to_numpy(), _column(table, "score"), _column(table, "uri")
    below = np.ones(len(table), dtype=bool)
    if pa.types.is_floating(score.type):
        below = ~pc.fill_null(pc.is_nan(score), False).to_numpy(zero_copy_only=False)
    by_score = pc.rank(score, "descending", null_placement="at_end", tiebreaker="dense").to_numpy()
    # URIs are compared among the rows that scores leave alone.
    order = np.lexsort((by_score, below, number))
    place = _places(number[order])
    last = order[np.maximum(np.arange(len(order)) - np.maximum(place - (k - 1), 0), 0)]
    left = (below[order] == below[last]) & (by_score[order] == by_score[last])
    order = order[(place < k) | left] if k > 0 else order[:0]
    by_uri = uri.take(pa.array(order))
    by_uri = pc.rank(by_uri, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
    order = order[np.lexsort((by_uri, by_score[order], below[order], number[order]))]
    return table.take(pa.array(order[_places(number[order]) < k]))


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table[name].combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _places(numbers: np.ndarray) -> np.ndarray:
    """Of rows ordered by number, the place among those with the same one, from 0."""
    at = np.arange(len(numbers))
    first = np.diff(numbers, prepend=-1) != 0
    return at - np.maximum.accumulate(np.where(first, at, 0))
