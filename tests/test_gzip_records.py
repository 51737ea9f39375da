"""Large .gz files read in ranges: the records of a whole read, each once."""

import gzip
import io
import random

import pytest

import crawlindex
from crawlindex import read_records
from crawlindex.sources import gzip_records as gz

MARK = b"WARC/1.0\r\n"


def record(i, body):
    return MARK + f"WARC-Type: conversion\r\nWARC-Target-URI: http://a.com/{i}\r\n\r\n".encode() + body + b"\r\n\r\n"


def bodies(seed, n=40):
    rng = random.Random(seed)
    return [
        rng.choice([
            b"", b"short", rng.randbytes(rng.randint(0, 3000)), b"WARC/1.0\r\n", b"\x1f\x8b\x08" * 30,
            b"a\r\n\r\nb " * rng.randint(1, 400), gzip.compress(b"inner"), "ünï ".encode() * 50,
        ])
        for _ in range(n)
    ]


def members(texts, level=6):
    return b"".join(gzip.compress(t, level, mtime=0) for t in texts)


def in_ranges(data, size):
    out = []
    for start in range(0, len(data), size):
        end = min(start + size, len(data))
        out += gz.records_of(io.BytesIO(data), len(data), start, end)
    return out


def whole(text):
    return text.split(b"\r\n\r\n" + MARK)


@pytest.mark.parametrize("seed", range(6))
def test_ranges_of_any_size_hold_each_record_once(seed):
    texts = [record(i, b) for i, b in enumerate(bodies(seed))]
    for data in (members(texts), members(texts, 0), members([b"".join(texts[:9]), *texts[9:]])):
        for size in (1, 7, 100, 1000, 5000, len(data)) if seed == 0 else (61, 4096):
            assert in_ranges(data, size) == whole(b"".join(texts))


def test_records_cut_over_members():
    """Members that begin inside a record go with the one before."""
    text = b"".join(record(i, b"x" * 50 + b"\r\n\r\n" + b"y" * 50) for i in range(30))
    for step in (37, 200, 10**6):
        data = members([text[i : i + step] for i in range(0, len(text), step)])
        for size in (10, 100, 1000):
            assert in_ranges(data, size) == whole(text)


def test_broken_and_empty_files():
    assert in_ranges(b"", 10) == [] and in_ranges(gzip.compress(b""), 10) == []
    data = members([record(0, b"x" * 9000)], 0)
    with pytest.raises(EOFError):
        in_ranges(data[:-100], 10**6)


def test_same_rows_as_the_plain_reader(spark, tmp_path, monkeypatch):
    for name in ("a", "b", "c"):
        texts = [record(i, b) for i, b in enumerate(bodies(ord(name), 60))]
        (tmp_path / f"{name}.warc.gz").write_bytes(members(texts))
    (tmp_path / "_SUCCESS").write_bytes(b"")

    def rows(frame):
        return sorted(bytes(r.v) for r in frame.selectExpr("cast(value AS binary) AS v").collect())

    plain = read_records(spark, f"{tmp_path}/*.gz")
    split = read_records(spark, f"{tmp_path}/*.gz", split_bytes=5000)
    assert plain.rdd.getNumPartitions() <= 3 < 12 < split.rdd.getNumPartitions()
    assert split.columns == ["value"] and rows(split) == rows(plain)
    several = read_records(spark, [f"{tmp_path}/a.warc.gz", f"file://{tmp_path}/b.warc.gz"], split_bytes=700)
    assert rows(several) == rows(read_records(spark, [f"{tmp_path}/a.warc.gz", f"{tmp_path}/b.warc.gz"]))
    assert rows(read_records(spark, str(tmp_path), split_bytes=10**9)) == rows(plain)


def test_very_many_small_ranges_share_tasks(spark, tmp_path, monkeypatch):
    """The driver keeps a record of each task, so their number is bounded by the
    bytes, however small the ranges; each record comes once."""
    texts = [record(i, b) for i, b in enumerate(bodies(5, 300))]
    for name in ("a", "b"):
        (tmp_path / f"{name}.warc.gz").write_bytes(members(texts))
    size = (tmp_path / "a.warc.gz").stat().st_size
    split = read_records(spark, str(tmp_path), split_bytes=100)
    assert 2 * size // 100 > gz.MANY_RANGES
    assert split.rdd.getNumPartitions() == 2
    plain = read_records(spark, f"{tmp_path}/*.gz")
    found, wanted = (sorted(bytes(r.v) for r in f.selectExpr("cast(value AS binary) AS v").collect()) for f in (split, plain))
    assert found == wanted
    monkeypatch.setattr(gz, "TASK_BYTES", 30_000)
    for step, file_bytes in ((100, 10**6), (7, 29_999), (40_000, 10**8), (100, 500)):
        reader = gz._Reader({"files": f'[["a", {file_bytes}], ["b", {file_bytes}]]', "splitBytes": str(step)})
        tasks = reader.partitions()
        assert [(t.path, t.start) for t in tasks[1:]] == [
            ("b", 0) if t.end == file_bytes else (t.path, t.end) for t in tasks[:-1]
        ]
        assert all(t.split == step and t.start % step == 0 for t in tasks)
        assert max(t.end - t.start for t in tasks) <= max(step, 30_000)


def test_wrong_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x")
    with pytest.raises(ValueError, match="no .gz file"):
        read_records(spark, str(tmp_path), split_bytes=10)
    with pytest.raises(FileNotFoundError):
        read_records(spark, f"{tmp_path}/none*.gz", split_bytes=10)


def test_locations(monkeypatch):
    assert [gz.opened(u)[1] for u in ("/x/y", "file:/x/y", "file:///x/y")] == ["/x/y"] * 3
    asked = []

    class Stores:
        class FileSystem:
            from_uri = asked.append

    monkeypatch.setattr(gz, "fs", Stores)
    for uri in ("s3a://b/k", "hdfs://n:1/k", "gs://b/k"):
        gz.opened(uri)
    assert asked == ["s3://b/k", "hdfs://n:1/k", "gs://b/k"]


def test_index_of_split_files(spark, tmp_path):
    """The whole job takes the option."""
    link = '{"Envelope":{"Payload-Metadata":{"HTTP-Response-Metadata":{"HTML-Metadata":{"Links":[{"url":"http://b.com/"}]}}}}}'
    wet = [MARK + f"WARC-Type: conversion\r\nWARC-Target-URI: http://a.com/{i}\r\n\r\nspark {i}\r\n\r\n".encode() for i in range(50)]
    wat = [MARK + f"WARC-Type: metadata\r\nWARC-Target-URI: http://{d}.com/\r\n\r\n{link}\r\n\r\n".encode() for d in "ab"]
    (tmp_path / "x.wet.gz").write_bytes(members(wet))
    (tmp_path / "x.wat.gz").write_bytes(members(wat))
    index = crawlindex.build_index(
        spark, f"{tmp_path}/x.wet.gz", f"{tmp_path}/x.wat.gz", f"{tmp_path}/index", split_bytes=300
    )
    assert index.where("keyword = 'spark'").count() == 50
