"""Rendering of crawl files from tables: what moves, how many files there are."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from crawlindex import read_records, testing


@pytest.fixture()
def tables(spark, tmp_path):
    """60 documents in six files, at 20 pages."""
    documents = spark.range(60).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    documents.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(20).selectExpr(
        "id AS page_id", "concat('http://h', id % 3, '/', id) AS url",
        """concat('<a href="http://x/', id, '">') AS html""",
    ).write.parquet(f"{tmp_path}/pages.parquet")
    names = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"
    before = [spark.conf.get(name) for name in names]
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield str(tmp_path)
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def test_texts_move_once_and_html_never(spark, tables, monkeypatch):
    written = []
    monkeypatch.setattr(testing, "write_records", lambda records, path: written.append(records))
    testing.crawl(spark, tables)
    wet, wat = [frame._jdf.queryExecution().executedPlan().toString() for frame in written]
    assert "RoundRobinPartitioning" not in wet + wat
    moved = [part.splitlines()[1] for part in wat.split("Exchange hashpartitioning")[1:]]
    assert all("html" not in line or "regexp_extract_all" in line for line in moved)


def test_a_larger_crawl_has_more_gzip_files(spark, tables):
    wet, wat = testing.gzip_crawl(spark, tables)
    files = [f for f in Path(wet).iterdir() if f.suffix == ".gz"]
    assert len(files) > 2 and all(f.stat().st_size for f in files)
    for folder, records in ((wet, testing.wet_records(spark, tables)), (wat, testing.wat_records(spark, tables))):
        got = sorted(r[0] for r in read_records(spark, folder, split_bytes=100).collect())
        assert got == sorted(r[0] for r in records.collect())


def test_documents_without_a_text_have_no_gzip_record(spark, tmp_path):
    spark.createDataFrame([(i, None if i % 3 == 0 else f"text {i}") for i in range(9)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, f"http://h/{i}" if i else None, "") for i in range(4)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    for folder, records in zip(testing.gzip_crawl(spark, str(tmp_path)), (testing.wet_records, testing.wat_records)):
        want = sorted(r[0] for r in records(spark, str(tmp_path)).where("value IS NOT NULL").collect())
        assert sorted(r[0] for r in read_records(spark, folder, split_bytes=100).collect()) == want


def test_texts_are_not_moved_for_the_link_graph(spark, tables, monkeypatch):
    rendered = []
    for kind in ("wet_records", "wat_records"):
        render = getattr(testing, kind)
        monkeypatch.setattr(
            testing, kind, lambda *of, kind=kind, render=render: rendered.append(kind) or render(*of)
        )
    vertices = entry_module.vertices_updated(spark, tables)
    assert sorted(r[0] for r in vertices.collect()) == ["h0", "h1", "h2"]
    assert rendered == ["wat_records"]
    for _ in range(2):
        texts = entry_module.scan_wet(spark, tables)
        metadata = entry_module.scan_wat(spark, tables)
    assert rendered == ["wat_records", "wet_records"]
    for got, records in ((texts, testing.wet_records), (metadata, testing.wat_records)):
        want = sorted(r[0] for r in records(spark, tables).collect())
        assert sorted(r[0] for r in got.collect()) == want
