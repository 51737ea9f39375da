"""Keyword columns: splitting, cleaning and counting the words of a text.

A word is cleaned in this order: delete non-ASCII characters, drop it when it
is all punctuation, delete one trailing punctuation character, lower-case it.
Word boundaries are ASCII, so the first and last step run on the whole text at
once; a separator takes the punctuation character before it along; and what
still is all punctuation was so from the start.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import STOP_WORDS

_NON_ASCII = r"\P{ASCII}+"
# White space and the pipe separate words, so the punctuation has no pipe.
# (Named classes: Java matches them several times faster than unions of ranges.)
_SEPARATOR = r"[\p{Punct}&&[^|]]?[\s|]+"
_NOT_PUNCTUATION = r"\P{Punct}"


def words(text: Column | str) -> Column:
    """array<string> of a text's words; select with `is_word` or `is_keyword`."""
    ascii_only = F.lower(F.regexp_replace(text, _NON_ASCII, ""))
    return F.split(F.concat(ascii_only, F.lit(" ")), _SEPARATOR)


def is_word(word: Column) -> Column:
    """False for what is left of blanks and of all-punctuation words."""
    return word.rlike(_NOT_PUNCTUATION)


def is_keyword(word: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """True for words that are not stop words."""
    return is_word(word) & ~word.isin(*stop_words)


def as_keyword(query: Column | str) -> Column:
    """A query cleaned the way texts are."""
    return F.array_join(F.filter(words(query), is_word), " ")


def count_words(text: Column | str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """array<struct<keyword, keyword_weight>> of a text, in keyword order.

    In sorted words equal ones are neighbours, so a run's length is the
    distance between two run starts: no shuffle, and linear after the sort.
    """

    def run_starts(sorted_words: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(sorted_words) - 1),
            lambda i: ~F.equal_null(F.get(sorted_words, i), F.get(sorted_words, i - 1)),
        )

    def run_lengths(sorted_words: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, i: F.struct(
                F.get(sorted_words, start).alias("keyword"),
                (F.coalesce(F.get(starts, i + 1), F.size(sorted_words)) - start).alias(
                    "keyword_weight"
                ),
            ),
        )

    counted = _let(
        F.sort_array(words(text)),
        lambda ws: _let(run_starts(ws), lambda starts: run_lengths(ws, starts)),
    )
    return F.filter(counted, lambda k: is_keyword(k["keyword"], stop_words))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once per row.

    Inside the lambdas of array functions a plain expression would be computed
    again for every element.
    """
    return F.get(F.transform(F.array(value), use), 0)


def by_weight(keywords: Column) -> Column:
    """Keyword structs, most frequent first, ties by keyword."""
    keyed = F.transform(
        keywords,
        lambda k: F.struct((-k["keyword_weight"]).alias("order"), k["keyword"].alias("keyword")),
    )
    return F.transform(
        F.sort_array(keyed),
        lambda k: F.struct(
            k["keyword"].alias("keyword"), (-k["order"]).alias("keyword_weight")
        ),
    )
