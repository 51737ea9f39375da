"""Compressed blocks: codes, round trips, pruned look-ups, size."""

import random
from pathlib import Path

import numpy as np
import pytest

from crawlindex import read_packed_index, unpacked, write_index, write_packed_index
from crawlindex.sources import packed_store

SCHEMA = "keyword string, uri string, occurences int, page_rank double"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_codes():
    rng = random.Random(1)
    for _ in range(200):
        values = np.array([rng.getrandbits(rng.randint(0, 62)) for _ in range(rng.randint(0, 40))], np.int64)
        data, sizes = packed_store.to_varints(values)
        assert sizes.tolist() == [max(1, -(-int(v).bit_length() // 7)) for v in values]
        assert packed_store.from_varints(data).tolist() == values.tolist()
    assert packed_store.to_varints(np.array([300]))[0].tolist() == [0b10101100, 0b10]


@pytest.mark.parametrize("block_rows", [1, 7, 4096])
def test_round_trip(spark, tmp_path, block_rows):
    rng = random.Random(block_rows)
    data = [
        (rng.choice(["hot"] * 9 + ["a", "é", ""]), f"http://h{rng.randrange(9)}/{rng.randrange(900)}",
         rng.choice([1, 2, 300, 70_000]), rng.choice([0.5, 1.25, None]))
        for _ in range(3000)
    ] + [("twice", "u", 1, 1.0)] * 3 + [("none", None, 1, 1.0)]
    frame = spark.createDataFrame(data, SCHEMA)
    path = str(tmp_path / "p")
    write_packed_index(frame, path, buckets=3, block_rows=block_rows)
    index = read_packed_index(spark, path)
    assert rows(unpacked(index)) == rows(frame)
    assert rows(unpacked(index, ["hot", "twice", "missing"])) == rows(frame.where("keyword IN ('hot', 'twice')"))
    most = index.blocks.selectExpr("max(n)").first()[0]
    assert most <= block_rows
    plan = unpacked(index, ["a"])._jdf.queryExecution().toString()
    assert "EqualTo(keyword,a)" in plan and "PartitionFilters: [isnotnull(bucket" in plan


def test_blocks_that_go_on_in_the_next_batch(spark, tmp_path):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    frame = spark.range(500).selectExpr(
        "concat('w', id % 3) AS keyword", "concat('u', id) AS uri", "1 AS occurences", "1.0D AS page_rank"
    )
    try:
        spark.conf.set(name, "10")
        write_packed_index(frame, str(tmp_path / "p"), buckets=1, block_rows=64)
        index = read_packed_index(spark, str(tmp_path / "p"))
        assert rows(unpacked(index)) == rows(frame)
        assert index.blocks.count() == 3 * 3
    finally:
        spark.conf.set(name, before)


def test_size(spark, tmp_path):
    frame = spark.range(60_000).selectExpr(
        "concat('w', id % 700) AS keyword", "concat('http://host', id % 50, '.example.com/page/', id % 4000) AS uri",
        "int(id % 5 + 1) AS occurences", "double(id % 50) / 7 AS page_rank",
    )
    write_index(frame, str(tmp_path / "plain"), buckets=2)
    write_packed_index(frame, str(tmp_path / "packed"), buckets=2)

    def size(name):
        return sum(f.stat().st_size for f in Path(tmp_path / name).rglob("*.parquet"))

    assert size("packed") < 0.7 * size("plain")


def test_no_postings(spark, tmp_path):
    write_packed_index(spark.createDataFrame([("a", "u", 1, 1.0)], SCHEMA), str(tmp_path / "p"))
    assert rows(unpacked(read_packed_index(spark, str(tmp_path / "p")), ["b"])) == []
