"""Index forms, storage, look-ups, and how they take hot keys."""

import random
import re
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from crawlindex import (
    build_index,
    create_index_table,
    hit_counts,
    index_stats,
    inverted_index,
    keyword_lookup,
    page_rank,
    postings,
    postings_by_position,
    ranked_pages,
    read_index,
    scores,
    search,
    search_multi,
    search_multi_batch,
    search_with_totals,
    term_counts,
    unranked_postings,
    write_index,
)
from crawlindex.storage import new_folder, small_splits, stored
from test_warc import WARCINFO, records, wat_body, wat_record, wet_record

POSTINGS = [
    ("spark", "http://a/1", 3, 0.5),
    ("spark", "http://b/1", 1, 2.0),
    ("spark", "http://b/2", 1, 2.0),
    ("spark", "http://b/2", 1, 2.0),  # the same URI captured twice
    ("join", "http://a/1", 2, 0.5),
    ("join", "http://c/1", 1, 0.25),
]
SCHEMA = "keyword string, uri string, occurences int, page_rank double"


@pytest.fixture(scope="module")
def index(spark):
    path = new_folder(spark, "index")
    write_index(spark.createDataFrame(POSTINGS, SCHEMA), path, buckets=4)
    return read_index(spark, path)


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def plan(frame):
    return frame._jdf.queryExecution().toString()


def test_pages_without_a_rank_drop_out(spark):
    pages = spark.createDataFrame(
        [("u1", "a", "x"), ("u2", "b", "y"), ("u2", "b", "y")], "uri string, domain string, text string"
    )
    ranks = spark.createDataFrame([("b", 1.5), ("z", 1.0)], "domain string, pageRank double")
    assert rows(ranked_pages(pages, ranks)) == [("u2", "b", 1.5, "y")] * 2


def test_stored_index(spark, index, tmp_path):
    assert rows(index.drop("bucket")) == sorted(POSTINGS)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_index(index.drop("bucket"), index.inputFiles()[0].rsplit("/bucket=", 1)[0])
    path = f"{tmp_path}/index"
    for _ in range(2):
        write_index(index.drop("bucket").limit(2), path, buckets=2, mode="overwrite")
    assert read_index(spark, path).count() == 2


def test_index_as_a_catalog_table(spark, index):
    path = index.inputFiles()[0].rsplit("/bucket=", 1)[0]
    for _ in range(2):
        table = create_index_table(spark, "search_keywords", path)
    assert rows(table.drop("bucket")) == sorted(POSTINGS)
    assert "PartitionFilters: [isnotnull(bucket" in plan(keyword_lookup(table, "spark"))
    assert keyword_lookup(table, "spark").count() == 4
    spark.sql("DROP TABLE search_keywords")


def test_parallel_arrays_and_back(spark, index):
    arrays = inverted_index(index)
    assert arrays.columns == ["keyword", "block", "links", "occurences", "page_ranks"]
    assert {len(r.links) == len(r.occurences) == len(r.page_ranks) for r in arrays.collect()} == {True}
    join = arrays.filter("keyword = 'join'").first()
    assert tuple(join) == ("join", 0, ["http://a/1", "http://c/1"], [2, 1], [0.5, 0.25])
    assert rows(postings_by_position(arrays)) == sorted(POSTINGS)
    unranked = inverted_index(index.drop("page_rank", "bucket"))
    assert unranked.columns == ["keyword", "block", "links", "occurences"]
    assert rows(postings_by_position(unranked)) == sorted(p[:3] for p in POSTINGS)


def test_a_hot_keyword_gets_several_blocks(spark):
    hot = spark.range(0, 4000, 1, 8).selectExpr(
        # a third of the rows are copies of one page
        "'hot' AS keyword", "if(id % 3 = 0, 'copy', concat('u', id)) AS uri",
        "1 AS occurences", "1.0D AS page_rank",
    )
    cold = spark.createDataFrame(POSTINGS, SCHEMA)
    table = stored(hot.unionByName(cold), new_folder(spark, "postings"))
    arrays = inverted_index(table, block_rows=500)
    sizes = [r.n for r in arrays.filter("keyword = 'hot'").select(F.size("links").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 650
    assert arrays.filter("keyword <> 'hot'").count() == 2
    assert rows(postings_by_position(arrays)) == rows(table)
    assert rows(inverted_index(table.repartition(3), block_rows=500)) == rows(arrays)


def test_appending_keeps_all_hits(spark, tmp_path):
    path = f"{tmp_path}/index"
    frame = spark.createDataFrame(POSTINGS, SCHEMA)
    write_index(frame, path, buckets=16)
    with pytest.raises(ValueError, match="16 buckets"):
        write_index(frame, path, buckets=7, mode="append")
    write_index(frame, path, mode="append")
    assert keyword_lookup(read_index(spark, path), "spark").count() == 8
    new = f"{tmp_path}/new"  # an append where nothing is yet
    write_index(frame, new, buckets=3, mode="append")
    assert rows(read_index(spark, new).drop("bucket")) == sorted(POSTINGS)


def test_a_cold_keyword_lies_in_one_file_and_a_hot_one_in_several(spark, tmp_path):
    many = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('w', id % 200)) AS keyword", "concat('u', id) AS uri",
        "1 AS occurences", "1.0D AS page_rank",
    )
    write_index(many, f"{tmp_path}/i", buckets=2, file_rows=500)
    index = read_index(spark, f"{tmp_path}/i").select("keyword", F.input_file_name().alias("file"))
    files = index.distinct().groupBy("keyword").agg(F.count("*").alias("n"))
    by_keyword = {r.keyword: r.n for r in files.collect()}
    assert by_keyword.pop("hot") >= 3
    assert sum(n > 1 for n in by_keyword.values()) <= 12  # only at the files' borders


def test_bucket_number_follows_from_the_rows(spark, tmp_path):
    from crawlindex.sources.index_store import bucket_count

    many = spark.range(1000).selectExpr(
        "concat('w', id) AS keyword", "'u' AS uri", "1 AS occurences", "1.0D AS page_rank"
    )
    write_index(many, f"{tmp_path}/i", file_rows=50)
    assert bucket_count(read_index(spark, f"{tmp_path}/i")) == 5


def test_hits_of_an_unranked_index(spark, index):
    unranked = index.drop("page_rank")
    assert rows(hit_counts(unranked, ["spark", "none"])) == [("none", 0), ("spark", 4)]


def test_totals_with_the_top_results(spark, index):
    got = rows(search_with_totals(index, ["spark", "join", "none"], k=1).drop("score_text"))
    assert got == [("join", "http://a/1", 1.0, 2), ("spark", "http://b/1", 2.0, 4)]
    assert len(rows(search(index, ["spark", "join"], k=5000))) == 6


def test_tables_of_several_word_queries(spark, index):
    asked = spark.createDataFrame([("spark join",), ("Join. spark",), ("none",), ("",), (None,)], "query string")
    top = search_multi_batch(index, asked, k=2)
    assert rows(top.filter("query = 'spark join'")) == [
        ("spark join", "http://a/1", 2, 2.5), ("spark join", "http://b/2", 1, 4.0),
    ]
    assert rows(top.filter("query = 'Join. spark'").select("matched")) == [(1,), (1,)]
    clean = search_multi_batch(index, asked, k=2, normalize=True)
    assert rows(clean.filter("query = 'Join. spark'").select("matched")) == [(1,), (2,)]


def test_a_posting_moves_once_for_all_queries_of_several_words(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("crawlindex.operators.search.TASK_HITS", 500, raising=False)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    data = [(rng.choice(words), f"u{rng.randrange(30)}", rng.randint(1, 9), rng.choice([0.5, 2.0])) for _ in range(600)]
    queries = [" ".join(rng.choices([*words, "none"], k=rng.randint(1, 8))) for _ in range(40)]
    write_index(spark.createDataFrame(data, SCHEMA), f"{tmp_path}/i", buckets=3)
    asked = spark.createDataFrame([(q,) for q in [*queries, queries[0], " "]], "query string")
    top = search_multi_batch(read_index(spark, f"{tmp_path}/i"), asked, k=3)
    want = []
    for query in set(queries):
        pages = {}
        for keyword, uri, n, rank in data:
            if keyword in query.split():
                pages.setdefault(uri, []).append((keyword, n * rank))
        best = sorted((-sum(s for _, s in hits), uri, len({w for w, _ in hits})) for uri, hits in pages.items())
        want += [(query, uri, matched, -score) for score, uri, matched in best[:3]]
    assert rows(top) == sorted(want)
    final = top._jdf.queryExecution().executedPlan().toString()
    # Pages are added up where their postings are: no exchange by query and page.
    assert "hashpartitioning(uri#" in final
    assert not re.search(r"hashpartitioning\((query|_number)#\w+, uri#", final)


def test_tasks_of_a_write_hold_rows_they_can_sort(spark, tmp_path):
    many = spark.range(3_900_000).selectExpr("concat('w', id % 900) AS keyword", "concat('u', id) AS uri")
    write_index(many, f"{tmp_path}/i", buckets=1)
    files = read_index(spark, f"{tmp_path}/i").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) < 3_000_000


def test_tasks_of_a_write_deal_out_rows_they_can_hold(spark, tmp_path, monkeypatch):
    """Postings of one task, which an index of more than 200 files sorts in memory."""
    most = []

    def write(table, *_):
        with small_splits(spark):
            tasks = table.groupBy(F.spark_partition_id()).count()
            most.append(tasks.agg(F.max("count")).first()[0])

    monkeypatch.setattr("crawlindex.sources.index_store.write_stored_index", write)
    many = spark.range(0, 6_000_000, 1, 1).selectExpr("concat('w', xxhash64(id) % 3000) AS keyword", "concat('u', id div 200) AS uri")
    write_index(many, f"{tmp_path}/i", buckets=1)
    assert 0 < most[0] < 5_000_000


def test_a_posting_is_no_larger_in_an_index_of_many_pages(spark, tmp_path):
    sizes = []
    for pages in (5_000, 60_000):
        many = spark.range(300_000).selectExpr(
            "concat('w', id % 50) AS keyword", "1 AS occurences",
            f"concat('https://www.example.org/en/', xxhash64(id * 7919 % {pages}), '?page=2') AS uri",
        )
        write_index(many, f"{tmp_path}/{pages}", buckets=1)
        files = Path(f"{tmp_path}/{pages}").rglob("*.parquet")
        sizes.append(sum(f.stat().st_size for f in files) - pages * 35)  # without the dictionary
    assert sizes[1] < 2 * sizes[0]


def test_a_table_of_queries_prunes_the_index(spark, index):
    asked = spark.createDataFrame([("join",)], "query string")
    assert "dynamicpruning" in plan(scores(index, asked))


def test_rank_join_follows_the_threshold(spark):
    """150,000 ranks: broadcast if their stored size allows it, else a shuffle."""
    ranks = spark.range(150_000).selectExpr("concat('d', id) AS domain", "1.0D AS pageRank")
    ranks = stored(ranks, new_folder(spark, "ranks"))
    pages = spark.range(1000).selectExpr("'u' AS uri", "concat('d', id) AS domain", "'t' AS text")
    pages = stored(pages, new_folder(spark, "pages"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, join in (("64m", "BroadcastHashJoin"), ("10k", "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            big = pages.union(pages.limit(0)) if join == "BroadcastHashJoin" else ranks.select(
                F.lit("u").alias("uri"), "domain", F.lit("t").alias("text")
            )
            assert join in ranked_pages(big, ranks)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_command_line(tmp_path):
    """As spark-submit runs it: the file itself, from another folder."""
    import gzip
    import subprocess
    import sys
    from pathlib import Path

    wet = "WARC/1.0" + WARCINFO + "".join(
        "WARC/1.0" + wet_record(f"http://a.com/{i}", "spark joins") for i in range(20)
    )
    link = wat_body({"url": "http://b.com/"})
    wat = "WARC/1.0" + wat_record("http://a.com/1", link) + "WARC/1.0" + wat_record("http://b.com/", link)
    for name, text in (("a.wet.gz", wet), ("a.wat.gz", wat)):
        (tmp_path / name).write_bytes(gzip.compress(text.encode()))
    (tmp_path / "stop.txt").write_text("joins\n")
    main = str(Path(__file__).resolve().parents[1] / "crawlindex" / "__main__.py")

    def run(*args):
        done = subprocess.run(
            [sys.executable, main, *args], cwd=tmp_path, capture_output=True, text=True, timeout=300
        )
        assert done.returncode == 0, done.stderr[-2000:]
        return done.stdout

    run("index", "a.wet.gz", "a.wat.gz", "index", "--partitions", "3", "--stop-words", "stop.txt")
    shown = run("search", "index", "Spark", "joins", "--normalize")
    assert "http://a.com/7" in shown and "|Spark|20" in shown.replace(" ", "")
    assert "|joins|0" in shown.replace(" ", "")


def test_stats(spark, index):
    pages = spark.range(7)
    assert rows(index_stats(pages, index)) == [
        ("keywords_distinct", 2), ("keywords_total", 6), ("records", 7),
    ]


def test_look_up_is_exact_and_pruned(index):
    hits = keyword_lookup(index, "join")
    assert rows(hits) == sorted(p for p in POSTINGS if p[0] == "join")
    assert "EqualTo(keyword,join)" in plan(hits)
    assert "PartitionFilters: [isnotnull(bucket" in plan(hits)
    assert keyword_lookup(index, "Join").count() == 0
    assert keyword_lookup(index, ["join", "spark", "x"]).count() == 6


def test_top_results(index):
    got = [tuple(r) for r in search(index, "spark", k=3).collect()]
    assert got == [
        ("spark", "http://b/1", 2.0, "2.0000"),
        ("spark", "http://b/2", 2.0, "2.0000"),
        ("spark", "http://b/2", 2.0, "2.0000"),
    ]
    assert search(index, "spark").count() == 4
    assert "TakeOrderedAndProject" in plan(search(index, "spark", k=3))


@pytest.mark.parametrize("as_table", [False, True])
def test_many_queries(spark, index, as_table):
    words = ["spark", "join", "Join.", "none", "spark"]
    asked = spark.createDataFrame([(w,) for w in words], "query string") if as_table else words
    assert rows(hit_counts(index, asked)) == [("Join.", 0), ("join", 2), ("none", 0), ("spark", 4)]
    top = search(index, asked, k=1)
    assert "WindowGroupLimit" in plan(top)
    assert rows(top.select("query", "uri")) == [("join", "http://a/1"), ("spark", "http://b/1")]
    cleaned = rows(hit_counts(index, asked, normalize=True))
    assert cleaned == [("Join.", 2), ("join", 2), ("none", 0), ("spark", 4)]
    assert rows(scores(index, asked, normalize=True).groupBy("query").count()) == [
        ("Join.", 2), ("join", 2), ("spark", 4),
    ]


def test_score_text(spark):
    one = spark.createDataFrame([("w", "u", 1, 1234.00005), ("w", "v", 2, 0.5)], SCHEMA)
    assert [r.score_text for r in search(one, "w").collect()] == ["1234.0001", "1.0000"]


def test_several_keywords(index):
    got = [tuple(r) for r in search_multi(index, ["spark", "join", "spark"]).collect()]
    assert got == [
        ("http://b/2", 1, 4.0), ("http://a/1", 2, 2.5), ("http://b/1", 1, 2.0), ("http://c/1", 1, 0.25),
    ]
    assert search_multi(index, ["spark", "join"], k=1).count() == 1


def test_index_of_a_crawl(spark, tmp_path):
    wet = [WARCINFO, wet_record("https://a.com/1", "Spark joins spark."), wet_record("http://b.com/", "spark")]
    wet.append(wet_record("http://lonely.com/", "spark"))  # links to nobody: no rank
    to_b, to_a = {"url": "https://b.com/x"}, {"url": "http://a.com/"}
    wat = [wat_record("http://a.com/1", wat_body(to_b)), wat_record("https://b.com/", wat_body(to_a, to_b))]
    for name, values in (("wet", wet), ("wat", wat)):
        (tmp_path / name).mkdir()
        text = "".join("WARC/1.0" + value for value in values)
        (tmp_path / name / "part.txt").write_bytes(text.encode())
    index = build_index(
        spark, f"{tmp_path}/wet", f"{tmp_path}/wat", f"{tmp_path}/index", buckets=2
    )
    got = [(r.keyword, r.uri, r.occurences, round(r.page_rank, 6)) for r in index.collect()]
    assert sorted(got) == [
        ("joins", "https://a.com/1", 1, 1.0),
        ("spark", "http://b.com/", 1, 1.0),
        ("spark", "https://a.com/1", 2, 1.0),
    ]
    assert unranked_postings(records(spark, *wet)).filter("keyword = 'spark'").count() == 3


def test_properties_of_a_ranked_index(spark):
    pages = spark.range(40).selectExpr(
        "concat('http://d', id % 5, '/', id) AS uri", "concat('d', id % 5) AS domain",
        "concat('w', id % 3, ' w', id % 4, ' common') AS text",
    )
    edges = spark.range(4).selectExpr("concat('d', id) AS src", "concat('d', id + 1) AS dst", "1L AS n")
    vertices = spark.range(5).selectExpr("concat('d', id) AS domain")
    ranks = page_rank(vertices, edges)
    index = postings(term_counts(ranked_pages(pages, ranks)))
    assert index.agg(F.sum("occurences")).first()[0] == 40 * 3
    assert index.select("uri").distinct().count() == 40
    assert index.filter("page_rank IS NULL").count() == 0
    assert rows(postings_by_position(inverted_index(index))) == rows(index)


def test_skewed_domain_is_split_in_the_rank_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    pages = spark.range(0, 60000, 1, 8).selectExpr(
        "uuid() AS uri", "if(id % 3 = 0, 'hot', concat('d', id % 500)) AS domain", "uuid() AS text"
    )
    path = new_folder(spark, "pages")
    pages = stored(pages, path)
    ranks = stored(
        pages.select("domain").distinct().withColumn("pageRank", F.lit(1.0)), f"{path}-ranks"
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for hint in (ranks, ranks.hint("shuffle_hash")):
            joined = ranked_pages(pages, hint)
            assert len(joined.collect()) == 60000
            final = joined._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in final.split("Initial Plan")[0] or "isSkew" in final, final
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_totals_shrink_before_they_move(spark, index):
    """Below the first exchanges stand the cut to k and partial counts."""
    asked = spark.createDataFrame([("spark",), ("join",)], "query string")
    found = search_with_totals(index, asked, k=1)
    final = found._jdf.queryExecution().executedPlan().toString()
    assert final.count("WindowGroupLimit") >= 2
    assert "partial_count(1)" in final
    assert "windowspecdefinition(query" in final and "count(1) windowspecdefinition" not in final
