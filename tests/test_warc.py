"""Records, headers, text pages and metadata pages, also from bad input."""

import gzip
import json

from crawlindex import (
    header_field,
    header_fields,
    page_links,
    pages_by_top_domain,
    read_records,
    split_record,
    wat_pages,
    wet_pages,
    write_records,
)
from crawlindex.operators.links import links_long
from crawlindex.functions.urls import domain_pattern

WARCINFO = "\r\nWARC-Type: warcinfo\r\nWARC-Filename: x\r\n\r\nSoftware: y\r\n\r\n"


def wet_record(uri, text, kind="conversion"):
    return f"\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n\r\n{text}\r\n\r\n"


def wat_record(uri, body):
    return f"\r\nWARC-Type: metadata\r\nWARC-Target-URI: {uri}\r\n\r\n{body}\r\n\r\n"


def wat_body(*links):
    html = {"HTML-Metadata": {"Head": {"Link": []}, "Links": list(links)}}
    return json.dumps({"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": html}}})


def records(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_files_globs_and_gzip(spark, tmp_path):
    first = "WARC/1.0" + WARCINFO + "WARC/1.0" + wet_record("http://a.com/1", "one ü")
    (tmp_path / "a.wet").write_bytes(first.encode())
    with gzip.open(tmp_path / "b.wet.gz", "wb") as file:
        file.write(("WARC/1.0" + WARCINFO + "WARC/1.0" + wet_record("http://b.com/2", "two")).encode())
    both = read_records(spark, str(tmp_path))
    assert both.filter("value = ''").count() == 0
    expected = [("http://a.com/1", "a.com", "one ü"), ("http://b.com/2", "b.com", "two")]
    assert rows(wet_pages(both)) == expected
    assert rows(wet_pages(read_records(spark, f"{tmp_path}/*.wet*", partitions=3))) == expected
    assert rows(wet_pages(read_records(spark, f"{tmp_path}/*.wet"))) == expected[:1]


def test_no_text_is_lost_at_blank_lines_or_marks(spark, tmp_path):
    text = "first\r\n\r\nsecond WARC/1.0 third\r\nWARC/1.0 fourth\r\n\r\n\r\nWARC/1.0.1 fifth"
    file = "WARC/1.0" + WARCINFO + "WARC/1.0" + wet_record("http://a.com/1", text)
    file += "WARC/1.0" + wet_record("http://a.com/2", "next")
    (tmp_path / "a.wet").write_bytes(file.encode())
    read = read_records(spark, str(tmp_path))
    assert rows(wet_pages(read).select("text")) == [(text,), ("next",)]
    first = split_record(read, first_segment=True).select("body")
    assert ("first",) in rows(first)
    assert [r.value for r in read.collect()][1] == wet_record("http://a.com/1", text)


def test_written_records_are_read_back(spark, tmp_path):
    values = [WARCINFO, wet_record("http://a.com/1", "line\nline\r\nline|é")]
    write_records(records(spark, *values).coalesce(1), f"{tmp_path}/out")
    assert [r.value for r in read_records(spark, f"{tmp_path}/out").collect()] == values


def test_body_is_all_after_the_header(spark):
    table = records(spark, "", "h\r\n\r\nb\r\n\r\nmore\r\n\r\nmore", "only header")
    whole = [tuple(r) for r in split_record(table).collect()]
    assert whole == [("h", "b\r\n\r\nmore\r\n\r\nmore"), ("only header", None)]
    first = [tuple(r) for r in split_record(table, first_segment=True).collect()]
    assert first == [("h", "b"), ("only header", None)]


def test_header_fields(spark):
    header = "\r\nA: 1\r\nB: x: y\r\nodd line\r\nA: 2\r\nEmpty: "
    frame = records(spark, header)
    fields = frame.select(header_fields("value")).first()[0]
    assert [tuple(f) for f in fields] == [
        ("A", "1"), ("B", "x: y"), ("odd line", None), ("A", "2"), ("Empty", ""),
    ]
    got = frame.select(*[header_field("value", n) for n in ("A", "B", "Empty", "odd line", "a")])
    assert tuple(got.first()) == ("1", "x: y", "", "", "")


def test_field_order_does_not_matter_and_other_types_drop_out(spark):
    reordered = "\r\nWARC-Target-URI: http://b.com/\r\nWARC-Type: conversion\r\n\r\ntext"
    got = wet_pages(
        records(spark, WARCINFO, wet_record("http://a.com/", "x", kind="response"), reordered)
    )
    assert rows(got) == [("http://b.com/", "b.com", "text")]


def test_bad_text_records_do_not_fail(spark):
    no_body = "\r\nWARC-Type: conversion\r\nWARC-Target-URI: http://a.com/"
    no_uri = "\r\nWARC-Type: conversion\r\n\r\ntext"
    # A separator inside a text ends the record there; the rest has no type.
    cut = [wet_record("http://c.com/", "before ").removesuffix("\r\n\r\n"), " after\r\n\r\n"]
    got = wet_pages(records(spark, no_body, no_uri, *cut)).collect()
    assert [tuple(r) for r in got] == [
        ("http://a.com/", "a.com", None), ("", "", "text"), ("http://c.com/", "c.com", "before "),
    ]


def test_domain_by_pattern_and_top_domain(spark):
    frame = records(spark, wet_record("http://hello.co.uk/a", "x"))
    assert wet_pages(frame, domain=domain_pattern).first().domain == "ello.co.uk"
    assert tuple(pages_by_top_domain(frame).first()) == ("http://hello.co.uk/a", "uk", "x")


def test_wat_pages(spark):
    body = wat_body({"url": "/x"})
    got = wat_pages(
        records(
            spark,
            WARCINFO,
            wat_record("http://a.com:80/p", body),
            wat_record("ftp://b.com/", body),
            wat_record("HTTP://c.com/", body),
            wat_record("http:///nohost", body),
            wat_record("http://d.com/", "not json"),
            "\r\nWARC-Type: metadata\r\nWARC-Target-URI: http://e.com/",
        )
    )
    assert rows(got) == [("http://a.com:80/p", "a.com", body)]


def test_links_of_a_page(spark):
    links = [
        {"path": "A@/href", "url": "http://b.com/x,y"},
        {"url": "https://c.com", "path": "A@/href", "text": "c ] d"},
        {"path": "IMG@/src", "url": "/rel"},
        {"path": "A@/href", "text": "no target"},
        {"path": "A@/href", "url": ""},
    ]
    pages = wat_pages(
        records(
            spark,
            wat_record("http://a.com/", wat_body(*links)),
            wat_record("http://none.com/", wat_body()),
            wat_record("http://other.com/", '{"Envelope": {}}'),
            wat_record("http://broken.com/", '{"Envelope": '),
        )
    )
    expected = ["http://b.com/x,y", "https://c.com", "/rel"]
    assert [tuple(r) for r in page_links(pages).collect()] == [("a.com", expected)]
    assert [tuple(r) for r in links_long(pages).collect()] == [("a.com", x) for x in expected]
