"""Words counted in Arrow batches, held against the array functions."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crawlindex import term_counts
from crawlindex.functions import word_counts
from crawlindex.functions.text import count_words

SIGNS = "aBcZ!|._-'\" \t\n\x0b\x0c\r\x00\x7fé߀😀İKthe  "


@pytest.fixture(scope="module")
def pages(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choices(SIGNS, k=rnd.randrange(40))) for _ in range(3000)]
    texts += [None, "", "   ", "the", "!!", "a|b|", "x!! y!", "End.", "end"]
    rows = [(f"u{n % 700}" if n % 9 else None, n, text) for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "uri string, n long, text string").repartition(5)


def by_arrays(pages):
    kept = [c for c in pages.columns if c != "text"]
    return pages.select(*kept, F.inline(count_words("text")))


def same(got, wanted):
    assert got.dtypes == wanted.dtypes
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_same_words_and_counts(pages):
    same(term_counts(pages), by_arrays(pages))
    same(term_counts(pages.select("text")), by_arrays(pages.select("text")))


def test_bytes_that_are_no_text(spark):
    text = F.expr("cast(unhex('61C3282062E228A120C3412062FF63F09F986420C0AF63') as string)")
    same(term_counts(spark.range(3).select("id", text.alias("text"))),
         by_arrays(spark.range(3).select("id", text.alias("text"))))


def test_other_stop_words(spark):
    frame = spark.createDataFrame([("u", "one two the one")], "uri string, text string")
    got = {tuple(r) for r in term_counts(frame, ["one"]).collect()}
    assert got == {("u", "two", 1), ("u", "the", 1)}
    assert term_counts(frame, []).count() == 3


def test_rows_come_by_uri_and_keyword(spark):
    """So that equal URIs lie side by side in what is stored and shuffled."""
    rows = [(f"u{n * 7 % 50:02d}", f"w{n % 3} every") for n in range(50)]
    frame = spark.createDataFrame(rows, "uri string, text string").coalesce(1)
    got = [(r.uri, r.keyword) for r in term_counts(frame).collect()]
    assert len(got) == 100 and got == sorted(got)


def test_slices_of_a_batch(monkeypatch):
    monkeypatch.setattr(word_counts, "SLICE_BYTES", 10)
    texts = ["a b", None, "c" * 30, "", "a a", "d"] * 3
    batch = pa.record_batch({"uri": [f"u{n}" for n in range(18)], "text": texts})
    count = word_counts.counter("text", "uri", ())
    got = pa.Table.from_batches(count(iter([batch]))).to_pylist()
    wanted = []
    for n, text in enumerate(texts):
        words = (text or "").split()
        wanted += [(f"u{n}", word, words.count(word)) for word in set(words)]
    assert sorted(tuple(r.values()) for r in got) == sorted(wanted)
    assert sum(1 for _ in word_counts._slices(batch, "text")) > 3
