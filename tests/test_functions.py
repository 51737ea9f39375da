"""URL and keyword columns."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlindex import domain_pattern, page_keywords, term_counts, tokens, top_level_domain
from crawlindex.functions.fixed_values import STOP_WORDS
from crawlindex.functions.text import as_keyword
from crawlindex.functions.urls import is_http, unify_scheme, url_host

PUNCTUATION = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def column(spark, values, make):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(make(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "url, pattern, host",
    [
        ("https://www.example.com/x", "www.example.com", "www.example.com"),
        ("http://hello.com/a", "ello.com", "hello.com"),
        ("https://stackoverflow.com/q/1", "ackoverflow.com", "stackoverflow.com"),
        ("http://example.org:8080/p", "example.org", "example.org"),
        ("http://user@example.org/", "user", "example.org"),
        ("http://shop.test_under.com/a b", "op.test_under.com", "shop.test_under.com"),
        ("https://https.com/h", ".com", "https.com"),
    ],
)
def test_domain_of_a_page(spark, url, pattern, host):
    assert column(spark, [url], domain_pattern) == [pattern]
    assert column(spark, [url], url_host) == [host]


def test_hosts_of_odd_urls(spark):
    hosts = {
        "http://a.com": "a.com",
        "http://a.com:/p": "a.com",
        "http://a.com:port/": "",
        "http://a@b@c.com/": "",
        "http://[::1]:80/": "[::1]",
        "http://": "",
        "http:///path": "",
        "http://a.com?q": "a.com",
        "http://a.com#f": "a.com",
        "http://A.Com/": "A.Com",
        "http://a.com./": "a.com.",
        "http://.a.com/": ".a.com",
        "HTTP://a.com/": "",
        "mailto:me@a.com": "",
        "/relative": "",
    }
    assert column(spark, list(hosts), url_host) == list(hosts.values())


def test_scheme_and_top_domain(spark):
    urls = ["http://a.com", "https://a.com/https://b", "//a.com", "HTTPS://a.com"]
    assert column(spark, urls, is_http) == [True, True, False, False]
    assert column(spark, urls, unify_scheme) == [
        "http://a.com", "http://a.com/https://b", "//a.com", "HTTPS://a.com",
    ]
    hosts = ["www.bbc.co.uk", "localhost", "a.com.", ""]
    assert column(spark, hosts, top_level_domain) == ["uk", "localhost", "", ""]


def clean_words(text):
    """The cleaning rules word by word, as a check on the whole-text form."""
    words = []
    for word in text.translate({ord(c): " " for c in "\t\n\x0b\f\r|"}).split(" "):
        word = "".join(c for c in word if ord(c) < 128)
        if all(c in PUNCTUATION for c in word):
            continue
        if word[-1] in PUNCTUATION:
            word = word[:-1]
        words.append(word.lower())
    return words


def pages(spark, *texts):
    return spark.createDataFrame(
        [(f"u{i}", text) for i, text in enumerate(texts)], "uri string, text string"
    )


def test_token_golden(spark):
    text = "Hello... (world) don't foo|bar *** café a b THE end. x-y -- 中文"
    got = [r.keyword for r in tokens(pages(spark, text), stop_words=["none"]).collect()]
    assert got == ["hello..", "(world", "don't", "foo", "bar", "caf", "ab", "the", "end", "x-y"]
    assert got == clean_words(text)
    assert "the" not in [r.keyword for r in tokens(pages(spark, text)).collect()]


def test_texts_without_keywords(spark):
    empty = pages(spark, None, "", "  \n", "the ... | THE. --", "中文")
    assert tokens(empty).count() == 0
    assert term_counts(empty).count() == 0
    lists = [r.keywords for r in page_keywords(empty).orderBy("uri").collect()]
    assert lists == [None, [], [], [], []]


def test_counts_and_order_of_a_page(spark):
    two_captures = pages(spark, "b z b C c. b! the").unionByName(pages(spark, "b"))
    got = sorted(tuple(r) for r in term_counts(two_captures).collect())
    assert got == [("u0", "b", 1), ("u0", "b", 3), ("u0", "c", 2), ("u0", "z", 1)]
    first = page_keywords(pages(spark, "b z b C c. b! d")).first()
    assert [tuple(k) for k in first.keywords] == [("b", 3), ("c", 2), ("d", 1), ("z", 1)]


def test_counts_keep_the_other_columns_and_do_not_shuffle(spark):
    frame = pages(spark, "x y").withColumn("pageRank", F.lit(0.5))
    assert term_counts(frame).columns == ["uri", "pageRank", "keyword", "keyword_weight"]
    assert "Exchange" not in term_counts(frame)._jdf.queryExecution().toString()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB1é .,!|-'\t\n\r\x0b\x0c\x1f _中"), max_size=40), min_size=50, max_size=80))
def test_cleaning_equals_the_rules_word_by_word(spark, texts):
    frame = pages(spark, *texts)
    expected = Counter(
        (f"u{i}", word)
        for i, text in enumerate(texts)
        for word in clean_words(text)
        if word not in STOP_WORDS
    )
    assert Counter(tuple(r) for r in tokens(frame).collect()) == expected
    counted = {(r.uri, r.keyword): r.keyword_weight for r in term_counts(frame).collect()}
    assert counted == dict(expected)


def test_query_cleaning(spark):
    assert column(spark, ["Word.", "two Words", "...", ""], as_keyword) == [
        "word", "two words", "", "",
    ]


def test_stop_list():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 127
