"""A link graph over several crawls against one built from the pages as they are."""

import random

import pytest

from crawlindex import (
    crawls,
    edges_of,
    host_counts,
    links_long,
    page_host_counts,
    read_link_graph,
    update_link_graph,
    vertices_of,
    wat_pages,
)
from crawlindex.sources import graph_store
from test_warc import records, wat_body, wat_record


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def page(uri, links):
    return wat_record(uri, wat_body(*[{"url": link} for link in links]))


def random_crawl(seed, uris):
    rng = random.Random(seed)
    targets = [f"https://d{i}.com/x" for i in range(6)] + ["/relative", "http:///none"]
    return {
        uri: [rng.choice(targets) for _ in range(rng.choice([0, 1, 5]))] for uri in uris if rng.random() < 0.8
    }


def test_crawls_equal_the_pages_from_scratch(spark, tmp_path):
    path, state = str(tmp_path / "graph"), {}
    uris = [f"http://d{i % 6}.com/{i}" for i in range(30)]
    for number in range(4):
        crawl = random_crawl(number, uris if number != 2 else uris[:4])
        state |= crawl
        pages = wat_pages(records(spark, *[page(u, x) for u, x in crawl.items()]))
        assert update_link_graph(pages, path) == number
        scratch = host_counts(links_long(wat_pages(records(spark, *[page(u, x) for u, x in state.items()]))))
        counts = read_link_graph(spark, path)
        assert rows(counts) == rows(scratch)
        assert rows(vertices_of(counts)) == rows(vertices_of(scratch))
        assert rows(edges_of(counts, vertices_of(counts))) == rows(edges_of(scratch, vertices_of(scratch)))
    assert crawls(spark, path) == [0, 1, 2, 3]


def test_a_page_without_links_takes_its_old_ones_out(spark, tmp_path):
    path = str(tmp_path / "graph")
    first = page("http://a.com/", ["http://b.com/", "http://b.com/2"])
    update_link_graph(wat_pages(records(spark, first, page("http://b.com/", ["/x"]))), path)
    assert rows(read_link_graph(spark, path)) == [("a.com", "b.com", 2), ("b.com", None, 1)]
    update_link_graph(wat_pages(records(spark, page("http://a.com/", []))), path)
    assert rows(read_link_graph(spark, path)) == [("b.com", None, 1)]
    empty = wat_pages(records(spark, "x").limit(0))
    update_link_graph(empty, path)
    assert rows(read_link_graph(spark, path)) == [("b.com", None, 1)]
    assert rows(page_host_counts(empty)) == []


def test_a_failed_update_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "graph")
    with pytest.raises(FileNotFoundError):
        read_link_graph(spark, path)
    old = wat_pages(records(spark, page("http://a.com/", ["http://b.com/"])))
    new = wat_pages(records(spark, page("http://a.com/", ["http://c.com/"])))
    update_link_graph(old, path)
    with monkeypatch.context() as patch:
        patch.setattr(graph_store, "complete", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            update_link_graph(new, path)
    assert rows(read_link_graph(spark, path)) == [("a.com", "b.com", 1)]
    assert update_link_graph(new, path) == 1
    assert rows(read_link_graph(spark, path)) == [("a.com", "c.com", 1)]
