"""Benchmark decontamination against windows compared one by one."""

import hashlib
import random
import re

import pytest
from llm_data import documents

from crawlindex.llm import decontamination as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ITEMS = "item_id long, text string, doc string, _spans int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    """(words, hit words, items found) by looking every window up."""
    windows = {}
    for item, own in items:
        own = words(own)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(item)
    own, hit, found = words(text), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(own) - size + 1):
            ids = windows.get(tuple(own[i : i + size]))
            if ids is not None:
                found |= ids
                hit |= set(range(i, i + size))
    return len(own), hit, {str(i) for i in found if i is not None}


def random_case(rng):
    alphabet = ["a", "b", "c", "ü", "42"][: rng.randint(1, 5)]

    def text(most):
        return " ".join(rng.choice(alphabet) for _ in range(rng.randint(0, most)))

    items = [(rng.choice([None, 1, 2, 3, 10]), text(rng.choice([3, 20]))) for _ in range(rng.randint(0, 6))]
    docs = []
    for _ in range(8):
        doc = text(30) + " " + " ".join(rng.choice([t for _, t in items] or [""]) + rng.choice(["", " X!"]) for _ in range(2))
        docs.append(doc)
    return items, docs


@pytest.mark.parametrize("window", [1, 2, 4, 10])
def test_automaton_against_windows(window, monkeypatch):
    rng = random.Random(window)
    monkeypatch.setattr(dec, "CHUNK", 7)  # matches go on over chunks
    for _ in range(150):
        items, docs = random_case(rng)
        split = [(i and str(i), [w.encode() for w in words(t)]) for i, t in items]
        automaton = dec.build(split, window)
        for doc in docs:
            total, spans, met = automaton.spans(dec.words_of(doc))
            hit = {i for start, end in spans for i in range(start, end)}
            assert (total, hit, automaton.found(met)) == brute(doc, items, window)
            assert all(a < b for a, b in spans) and spans == sorted(spans)


def test_pieces_have_the_windows_of_the_whole(monkeypatch):
    monkeypatch.setattr(dec, "PIECE_WORDS", 13)
    for n in (1, 9, 10, 11, 13, 14, 17, 18, 40):
        own = [str(i).encode() for i in range(n)]
        pieces = list(dec.pieces_of(own, 10))
        assert max(map(len, pieces)) <= 13

        def windows(p):
            return [tuple(p[i : i + 10]) for i in range(max(1, len(p) - 9))]

        assert sorted(w for p in pieces for w in windows(p)) == sorted(windows(own))


def rows_of(found):
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated) for r in found),
        key=str,
    )


def test_odd_rows_and_several_blocks(spark):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    long = texts[8].split()
    items = [
        (1, " ".join(long[100:140]).upper()),
        (2, " ".join(long[29_000:29_010])),
        (2, "größe naïve"),
        (3, None),
        (4, " -- "),
        (None, " ".join(long[500:520])),
        (30, texts[4]),
        (5, "short"),
        (5, "short"),
        (6, "x" * 70_000),
    ]
    bench = spark.createDataFrame([(i, t, "d", 1) for i, t in items], ITEMS)
    expected = []
    for r in docs.collect():
        n, hit, found = brute(r.text, items)
        expected.append((r.doc_id, n, len(hit), len(found), tuple(sorted(found)), bool(hit)))
    expected.sort(key=str)
    assert rows_of(dec.contamination(docs, bench).collect()) == expected
    hit = dec._hit()
    for block_words in (100, 60):  # several automata, one after the other
        table = dec.matched(docs, bench, 10, ["doc_id"], block_words)
        found = table.select(
            "doc.doc_id", "_words", hit.alias("n"), "_items"
        ).collect()
        assert sorted([(r[0], r[1], r[2], len(r[3]), tuple(r[3]), r[2] > 0) for r in found], key=str) == expected


def test_removed_spans(spark):
    item = "One two three four five six seven eight nine ten eleven"
    text = f"Clean start, {item.upper()}! And a clean end that goes on for as long as the span itself. {item}."
    docs = documents(spark, [(1, text, "en"), (2, item + " more", "en"), (3, None, None), (4, "", None)])
    bench = spark.createDataFrame([(1, item, "d", 1)], ITEMS)
    rows = {r.doc.doc_id: r for r in dec.decontaminated(docs, bench, coverage=0.6).collect()}
    assert rows.keys() == {1, 3, 4}
    assert rows[1].doc.text == "Clean start, ! And a clean end that goes on for as long as the span itself. ."
    assert [text[s.start : s.end] for s in rows[1].spans] == [item.upper(), item]
    assert rows[3].doc.text is None and rows[4].doc.text == ""
    assert rows[1].doc.asDict().keys() == {*docs.columns}


def test_empty_tables(spark):
    bench = spark.createDataFrame([], ITEMS)
    found = dec.contamination(documents(spark), bench).collect()
    assert len(found) == documents(spark).count() and not any(r.contaminated for r in found)
    assert dec.contamination(documents(spark, []), bench).collect() == []


def test_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    found = {r.doc_id: r for r in dec.digest(docs, bench).collect()}
    some = 0
    for r in docs.collect():
        n, hit, ids = brute(r.text, items)
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert tuple(found[r.doc_id])[1:] == (n, len(hit), len(ids), sha, bool(hit))
        some += bool(hit)
    assert some
