"""Postings of a stored index, written anew in other forms where they are read."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crawlindex import (
    hit_counts,
    inverted_index,
    postings_by_position,
    read_impact_index,
    read_index,
    read_packed_index,
    search_impact,
    search_with_totals,
    unpacked,
    write_impact_index,
    write_index,
    write_packed_index,
)
from crawlindex.functions import sorted_lists
from crawlindex.operators import blocks
from crawlindex.operators.places import places_in_task
from crawlindex.sources import impact_store, index_store, packed_store
from crawlindex.storage import stored

SCHEMA = "keyword string, uri string, occurences int, page_rank double"
COLUMNS = ["keyword", "uri", "occurences", "page_rank"]


def rows(frame):
    return sorted(str(tuple(r)) for r in frame.collect())


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    """Three buckets of several files; a hot keyword lies in more than one, with
    copies of postings; a keyword and a URI are missing."""
    rng = random.Random(4)
    data = [
        (rng.choice(["hot"] * 20 + ["warm"] * 5 + [f"w{i}" for i in range(200)]), f"http://h{rng.randrange(7)}/{rng.randrange(300)}",
         rng.choice([1, 1, 2, 300]), rng.choice([0.5, 1.25, float("nan"), None]))
        for _ in range(4000)
    ]
    data += [("hot", "copy", 1, 1.0)] * 300 + [("none", None, 1, 1.0), (None, "u", 1, 1.0), ("", "u", 2, 1.0)]
    path = str(tmp_path_factory.mktemp("dealt") / "index")
    write_index(spark.createDataFrame(data, SCHEMA), path, buckets=3, file_rows=150)
    found = read_index(spark, path)
    assert len({r[0] for r in found.where("keyword = 'hot'").select(F.input_file_name()).collect()}) > 1
    return found


def refuse(*args, **options):
    raise AssertionError("postings were written or dealt out once more")


def test_an_index_is_written_anew_without_a_copy(spark, index, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "stored_postings", refuse)
    path = str(tmp_path / "bloom")
    write_index(index, path, buckets=3, bloom=True)
    again = read_index(spark, path)
    assert rows(again) == rows(index) and index_store.bucket_count(again) == 3
    asked = ["hot", "w3", "none", "missing"]
    assert rows(hit_counts(again, asked)) == rows(hit_counts(index, asked))
    write_index(index, str(tmp_path / "same"))
    assert rows(read_index(spark, str(tmp_path / "same"))) == rows(index)
    monkeypatch.undo()
    write_index(index, str(tmp_path / "other"), buckets=2)
    other = read_index(spark, str(tmp_path / "other"))
    assert index_store.bucket_count(other) == 2 and rows(other.drop("bucket")) == rows(index.drop("bucket"))


def test_the_impact_index_orders_postings_where_they_are(spark, index, tmp_path, monkeypatch):
    ranked = index.where("page_rank IS NOT NULL AND NOT isnan(page_rank)")
    path = str(tmp_path / "impact")
    with monkeypatch.context() as patch:
        patch.setattr(impact_store, "placed", refuse)
        half = F.md5("uri") >= "8"
        for part in (~half, half):
            write_impact_index(ranked.where(part), path, mode="append", block_rows=32)
    impact = read_impact_index(spark, path)
    assert impact.buckets == 3
    kept = ranked.where("keyword IS NOT NULL AND uri IS NOT NULL")
    assert rows(impact.postings.select(COLUMNS)) == rows(kept.select(COLUMNS))
    words = ["hot", "warm", "w3", "", "missing"]
    for asked in (words, spark.createDataFrame([(w,) for w in words], "query string")):
        for k in (1, 33, 5000):
            assert rows(search_impact(impact, asked, k)) == rows(search_with_totals(kept, asked, k))
    # A block has the best scores that its task holds of the keyword.
    assert impact.postings.groupBy("segment", "keyword").agg(F.min("place").alias("p")).where("p > 0").count() == 0
    write_impact_index(ranked.drop("bucket"), str(tmp_path / "dealt"), buckets=3, block_rows=32)
    dealt = read_impact_index(spark, str(tmp_path / "dealt"))
    assert rows(search_impact(dealt, words, 20)) == rows(search_with_totals(ranked.where("keyword IS NOT NULL"), words, 20))


@pytest.mark.parametrize("few", [True, False])
def test_postings_are_packed_where_they_are(spark, index, tmp_path, monkeypatch, few):
    """As long as page numbers can go to all executors, no posting is stored first."""
    tables = []

    def watched(table, *args, **options):
        tables.append(table.columns)
        return stored(table, *args, **options)

    monkeypatch.setattr(packed_store, "stored", watched)
    if not few:
        monkeypatch.setattr(packed_store, "BROADCAST_PAGES", 0)
    path = str(tmp_path / "packed")
    write_packed_index(index, path, block_rows=16)
    assert any("keyword" in t for t in tables) != few
    packed = read_packed_index(spark, path)
    kept = index.where("keyword IS NOT NULL").select(COLUMNS)
    assert index_store.bucket_count(packed.blocks) == 3
    assert rows(unpacked(packed)) == rows(kept)
    assert rows(unpacked(packed, ["hot", "none"])) == rows(kept.where("keyword IN ('hot', 'none')"))
    assert packed.blocks.selectExpr("max(n)").first()[0] <= 16
    numbers = packed.pages.orderBy("uri", "page_rank").collect()
    assert [r.page for r in numbers] == list(range(len(numbers)))


@pytest.mark.parametrize("block_rows", [30, 100_000])
def test_lists_of_a_stored_index_are_made_where_it_is_read(spark, index, monkeypatch, block_rows):
    wanted = inverted_index(index.drop("bucket"), block_rows)
    moved = []

    def watched(elements, *args):
        moved.append(elements.select("keyword").distinct().collect())
        return plain(elements, *args)

    plain = blocks._moved
    monkeypatch.setattr(blocks, "_moved", watched)
    found = inverted_index(index, block_rows)
    assert rows(found) == rows(wanted)
    assert rows(postings_by_position(found)) == rows(index.select(COLUMNS))
    files = index.select("keyword", F.input_file_name().alias("file")).distinct()
    files = files.groupBy("keyword").agg(F.count("*").alias("n"))
    several = {r.keyword for r in files.where("n > 1 OR keyword IS NULL").collect()}
    assert {r.keyword for r in moved[0]} <= several and {"hot", None} <= several
    # Wherever the rows of a keyword are, its lists are the same.
    assert rows(inverted_index(index.repartition(5), block_rows)) == rows(wanted)


def test_lists_and_places_over_batches():
    rng = random.Random(3)
    kind = pa.struct([("uri", pa.string()), ("n", pa.float64())])
    elements = [None, {"uri": None, "n": 1.0}, {"uri": "a", "n": None}, {"uri": "a", "n": float("nan")}, {"uri": "a", "n": 1.0}]
    data = [
        (k, e, i * 5, blocks)
        for k, blocks in (("", 1), ("a", 3), ("b", 2), ("c", 1), ("d", 7), ("e", 1))
        for i, e in enumerate(elements) for _ in range(rng.randrange(9))
    ]
    wanted, n = {}, 0
    for i, (k, e, digest, count) in enumerate(data):
        n = n + 1 if i and str(data[i - 1][:2]) == str((k, e)) else 0
        wanted.setdefault((k, 0 if e is None else (digest + n) % count), []).extend([] if e is None else [e])
    wanted = sorted((k, b, str(found)) for (k, b), found in wanted.items())
    columns = list(zip(*data, strict=True))
    table = pa.table({"k": columns[0], "e": pa.array(columns[1], kind), "_digest": columns[2], "_blocks": columns[3]})
    for size in (1, 2, 5, 1000):
        batches = table.to_batches(size)
        batches = [*batches[:1], batches[0].slice(0, 0), *batches[1:]]
        out = pa.Table.from_batches(sorted_lists.lists("k", "e", "l")(iter(batches))).to_pylist()
        assert sorted((r["k"], r["block"], str(r["l"])) for r in out) == wanted
        assert {r["_part"] for r in out} == {0}
        # Keys that are too long have several parts; all others are as before.
        out = pa.Table.from_batches(sorted_lists.lists("k", "e", "l", 10)(iter(batches))).to_pylist()
        cut = {r["k"] for r in out if r["_part"]}
        assert cut and all(columns[0].count(k) >= 10 for k in cut)
        assert sorted((r["k"], r["block"], str(r["l"])) for r in out if r["k"] not in cut) == [w for w in wanted if w[0] not in cut]
        places = pa.Table.from_batches(places_in_task("k")(iter(batches)))["pos"].to_pylist()
        assert places == [columns[0][:i].count(k) for i, k in enumerate(columns[0])]
