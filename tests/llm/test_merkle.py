"""Merkle manifests against trees built level by level."""

import hashlib
import random
import zlib

import pytest
from llm_data import documents

from crawlindex.llm import merkle

SF_DIR = "/root/testdata/sf0.01"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    fields = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([digest("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return out


def brute(rows):
    """Sorted results (as tuples of `verified`) of all rows."""
    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id, leaf(r, r.text), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for own in sources.values():
        own.sort(key=lambda x: (x[0], x[1] or 0, x[2]))
    trees = {s: levels([x[2] for x in sources[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names]) if names else []
    out = []
    for k, s in enumerate(names):
        for i, (_, doc_id, old, r) in enumerate(sources[s]):
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
            text = r.text.replace("\n", "") if tampered and r.text is not None else r.text
            node, siblings = leaf(r, text), []
            for tree, place in ((trees[s], i), (top, k)):
                for nodes in tree[:-1]:
                    start = place // 3 * 3
                    run = nodes[start : start + 3]
                    before, after = run[: place - start], run[place - start + 1 :]
                    siblings += before + after
                    node = digest("".join([*before, node, *after]))
                    place //= 3
            root = top[-1][0]
            out.append((doc_id, old, trees[s][-1][0], root, digest("".join(siblings)), node, node == root))
    return sorted(out, key=str)


def found(docs):
    return sorted((tuple(r) for r in merkle.verified(docs).collect()), key=str)


def table(spark, sizes, seed=1):
    """Documents in sources of the given sizes, ids in random order."""
    rng = random.Random(seed)
    rows = [(f"s{k}" if k else None, i) for k, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    data = [(rng.randrange(10**9), f"text\n{i}", "en", s, i) for s, i in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars int")


@pytest.mark.parametrize("levels_of_block", [1, 2, 4])
@pytest.mark.parametrize("sizes", [[1], [0, 2], [3, 4, 1], [100, 9, 10, 27, 28, 1, 1, 1, 81, 82, 250]])
def test_trees_of_all_shapes(spark, sizes, levels_of_block, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", levels_of_block)
    monkeypatch.setattr(merkle, "_BLOCK", 3**levels_of_block)
    top, _ = merkle.sweep_up(["a"], 0)
    assert top == "a"
    docs = table(spark, sizes)
    # Workers import the module as it is; sweeps are held in this process.
    rows = docs.collect()
    for n in sizes:
        nodes = [digest(str(i)) for i in range(n)]
        if n and n <= 3**levels_of_block:
            up, children = merkle.sweep_up(nodes, merkle.levels_of(n))
            assert up == levels(nodes)[-1][0]
            for place, step in merkle.sweep_down(children, merkle.levels_of(n)):
                node = nodes[place]
                while step:
                    node, step = digest(step[0] + node + step[1]), step[2]
                assert node == up
    if levels_of_block == 4:
        assert found(docs) == brute(rows)


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, clashing names."""
    docs = documents(spark)
    docs = docs.unionByName(docs.withColumn("source", docs.source.substr(2, 1)).limit(5))
    docs = docs.withColumns({"grp": docs.lang, "pos": docs.n_chars, "block": docs.lang, "proof": docs.lang})
    assert found(docs) == brute(docs.collect())


def test_no_rows(spark):
    assert found(documents(spark, [])) == []


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = found(docs)
    assert rows == brute(docs.collect())
    assert 0 < sum(r[-1] for r in rows) < len(rows)


def test_proofs_lead_to_the_root(spark):
    """Real proofs fold to the root; another leaf does not."""
    rows = merkle.manifest(table(spark, [5, 300, 2])).collect()
    assert len({r.root for r in rows}) == 1
    for r in rows:
        node, wrong = r.leaf, digest("x")
        for step in r.proof:
            node = digest(step.before + node + step.after)
            wrong = digest(step.before + wrong + step.after)
        assert node == r.root != wrong


def test_hot_source_is_spread(spark):
    """Range partitions hold a share of a source each; places have no gap."""
    rows = spark.range(20_000).selectExpr("'hot' AS grp", "(id * 7919) % 20011 AS k", "hex(id) AS digest")
    placed = merkle.placed(rows, "grp", [merkle.F.col("k")], merkle.new_folder(spark, "test"))
    places = [r.pos for r in placed.orderBy("k").select("pos").collect()]
    assert places == list(range(20_000))
    assert {r.n for r in placed.select("n").distinct().collect()} == {20_000}
