import numpy as np
import pytest
import xxhash
from llm_data import documents, prose, texts

import corpus_pipeline
from crawlindex.llm import simhash
from crawlindex.llm.components import components


def brute_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    return {v: find(v) for v in values}


def test_every_row_against_brute_force(spark):
    got = sorted(
        (r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id)
        for r in simhash.near_duplicates(documents(spark)).collect()
    )
    prints = [(i, brute_fingerprint(t)) for i, t, _ in texts()]
    roots = brute_components([p for _, p in prints])
    least = {}
    for i, p in prints:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    want = sorted((i is None, i or 0, f"{p:016x}", least.get(roots[p])) for i, p in prints)
    assert got == want


def near(base, rng, n, flips):
    out = []
    for _ in range(n):
        v = base
        for b in rng.choice(64, flips, replace=False):
            v ^= 1 << int(b)
        out.append(v)
    return out


@pytest.mark.parametrize("pairwise", [64, 2])
def test_links_lose_none(spark, monkeypatch, pairwise):
    """Random fingerprints with close ones; chains of links; a large group."""
    rng = np.random.default_rng(7)
    values = []
    for base in map(int, rng.integers(0, 2**63, 40)):
        values += [base, *near(base, rng, 4, 2), *near(base, rng, 4, 3), *near(base, rng, 2, 1)]
    chain = int(rng.integers(0, 2**63))
    for k in range(20):
        values.append(chain)
        chain ^= 3 << (3 * k)
    values += near(values[0], rng, 150, 2)
    values = sorted(set(values))
    monkeypatch.setattr(simhash, "_PAIRWISE", pairwise)
    if pairwise == 2:  # in this process: workers would not see the change
        fps = np.array(values, np.uint64)
        parts = [(a, fps[r], np.full(len(r), h)) for r, a, h in simhash._anchors(fps)]
        anchor, at, home = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(anchor, kind="stable")
        a, b = simhash._groups(anchor[order], at[order], home[order])
        root = simhash._roots(len(fps), np.searchsorted(fps, a), np.searchsorted(fps, b))
        got = {v: values[r] for v, r in zip(values, root, strict=True)}
    else:
        frame = spark.createDataFrame([(np.uint64(v).view(np.int64).item(),) for v in values], "fp long")
        found = components(simhash.fingerprint_links(frame)).collect()
        got = {v: v for v in values}
        got |= {r.node % 2**64: r.root % 2**64 for r in found}
    want = brute_components(values)
    groups = {}
    for v in values:
        groups.setdefault(want[v], set()).add(got[v])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_any_two_bits_meet_at_an_anchor():
    rng = np.random.default_rng(1)
    for _ in range(20):
        x = int(rng.integers(0, 2**63))
        pair = np.array([x, near(x, rng, 1, 2)[0]], np.uint64)
        at = [(rows, anchors) for rows, anchors, _ in simhash._anchors(pair)]
        mine = [{int(a) for r, s in at for i, a in zip(r, s, strict=True) if i == k} for k in (0, 1)]
        home = next(simhash._anchors(pair))[1]
        assert home[0] in mine[1] and home[1] in mine[0]


def test_one_of_each_group_stays(spark):
    kept = simhash.deduplicated(documents(spark))
    assert kept.columns == documents(spark).columns
    groups = simhash.near_duplicates(documents(spark)).collect()
    want = sorted({r.component_id for r in groups if r.component_id is not None})
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == want


def test_one_row_of_each_group_whatever_its_id(spark):
    """Null ids, ids that unrelated texts share, repeated rows."""
    one, two, three = (prose(i, 80) for i in (21, 22, 23))
    rows = [(i, t, "en") for i, t, _ in texts()]
    rows += [(None, prose(30 + i, 80), "en") for i in range(5)]  # no id in their groups
    rows += [(None, prose(30, 80), "en"), (None, one, "en"), (None, None, "en")]
    rows += [(50, one, "en"), (50, two, "en"), (50, two, "en")]  # unrelated namesakes
    rows += [(60, three, "en"), (61, one, "en"), (61, prose(24, 80), "en"), (61, prose(24, 80), "en")]
    rows += [(49, two, "en"), (70, prose(25, 80), "en"), (70, prose(25, 80), "en")]
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    roots = brute_components(prints)
    want = {}
    for (i, t, _), p in zip(rows, prints, strict=True):
        place = (i is None, i or 0)
        want[roots[p]] = min(place, want.get(roots[p], place))
    kept = corpus_pipeline.near_dedup(spark, documents(spark, rows), "")
    assert kept.columns == documents(spark, rows).columns
    got = [(roots[brute_fingerprint(r.text)], (r.doc_id is None, r.doc_id or 0)) for r in kept.collect()]
    assert sorted(got) == sorted(want.items())


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    links = spark.createDataFrame(chain, "src long, dst long")
    root = {r.node: r.root for r in components(links).collect()}
    assert {root[i] for i in range(61)} == {0}
    assert {root[i] for i in range(1000, 1200)} == {1000}


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.deduplicated(documents(spark, [])).collect() == []
