"""Keywords of pages: words, counts per page, keyword lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from ..functions.fixed_values import STOP_WORDS
from ..functions.text import by_weight, count_words, is_keyword, words
from ..functions.word_counts import counter
from ..shipping import ship


def tokens(pages: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The pages' columns but `text`, and one row per `keyword` occurrence."""
    kept = [c for c in pages.columns if c != "text"]
    return pages.select(*kept, F.explode(words("text")).alias("keyword")).filter(
        is_keyword(F.col("keyword"), stop_words)
    )


def page_keywords(pages: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The pages' columns but `text`, and `keywords`: an array of
    struct<keyword, keyword_weight>, most frequent first, ties by keyword."""
    kept = [c for c in pages.columns if c != "text"]
    return pages.select(*kept, by_weight(count_words("text", stop_words)).alias("keywords"))


def term_counts(pages: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The pages' columns but `text`, and `keyword, keyword_weight` in long form.

    A page's words are counted where it is, so nothing is shuffled, and two
    captures of one URI stay two sets of rows. Tasks count in Arrow batches, of
    which each gives its rows in the order of `uri` and keyword.
    """
    ship(pages.sparkSession)
    kept = [c for c in pages.columns if c != "text"]
    schema = StructType([pages.schema[c] for c in kept])
    schema = schema.add("keyword", StringType()).add("keyword_weight", IntegerType())
    first = "uri" if "uri" in kept else None
    return pages.mapInArrow(counter("text", first, tuple(stop_words)), schema)
