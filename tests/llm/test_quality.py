import math
import re
from collections import Counter

import pytest
import xxhash
from llm_data import documents, prose, texts

from crawlindex.llm import quality

LABELS = "doc_id long, quality int, toxic int, words int"
EDGES = [
    (101, "a b c d e f g h i j a b c d e", None),
    (102, "a a a a a a a a a a a", None),
    (103, "l\n\nl\n l\nl\n \n#*$ %&|<>\n", None),
    (104, "one two three four five " * 2, None),
]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    counts = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
    return (*counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0])


def test_counts_against_brute_force(spark):
    rows = texts() + EDGES
    got = quality.text_counts(documents(spark, rows), "doc_id").drop("words").collect()
    order = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert sorted(str((r.doc_id, *(r[c] for c in order))) for r in got) == sorted(
        str((i, *brute(t))) for i, t, _ in rows
    )


def corpus():
    good = [(i, prose(i, 150), "en") for i in range(200, 260)]
    junk = [(i, "### ".join(prose(i, 150).split()), "en") for i in range(300, 320)]
    return good, junk


def test_junk_goes_and_clean_documents_stay(spark):
    good, junk = corpus()
    docs = documents(spark, good + junk)
    labels = spark.createDataFrame([(i, 1, 0, 5) for i, _, _ in good[:40]] + [(i, 0, 0, 5) for i, _, _ in junk[:10]] + [(None, 1, 0, 1), (200, 1, None, 1)], LABELS)
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(docs, labels).collect()}
    assert all(verdict[i] for i, _, _ in good)
    assert not any(verdict[i] for i, _, _ in junk)
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, _, _ in good}


def test_without_labels_the_base_rules_decide(spark):
    docs = documents(spark, texts())
    result = quality.quality_rules(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(result) == len(texts())
    assert all(r.kept == (not r.base_failed) and r.score == 0 for r in result)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert quality.quality_rules(none, spark.createDataFrame([], LABELS)).collect() == []


def test_no_python_in_the_plan(spark, capsys):
    docs = documents(spark, texts())
    quality.quality_rules(docs, spark.createDataFrame([(4, 1, 0, 5)], LABELS)).explain()
    assert "Python" not in capsys.readouterr().out


def brute_buckets(text):
    """Spark hashes several values by seeding each with the one before."""
    own = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]

    def signed(n):
        return n - (1 << 64) if n >> 63 else n

    single = [xxhash.xxh64_intdigest(w, 42) for w in own]
    pairs = [xxhash.xxh64_intdigest(b, a) for a, b in zip(single, own[1:], strict=False)]
    return [signed(h) % quality.BUCKETS for h in single + pairs]


def test_likelihood_ratio_against_brute_force(spark):
    good, junk = corpus()
    rows = good + junk + texts()
    docs = documents(spark, rows)
    trusted = {i for i, _, _ in good[:30]} | {12}  # id 12 comes twice
    labels = spark.createDataFrame([(i, 1, 0, 5) for i in trusted], LABELS)
    raw, target = Counter(), Counter()
    for i, text, _ in rows:
        raw.update(brute_buckets(text))
        if i in trusted:
            target.update(brute_buckets(text))
    share = target.total() / raw.total()

    def weight(b):
        return round(math.log((target[b] + quality.PRIOR) / (raw[b] * share + quality.PRIOR)), 4)

    want = []
    for i, text, _ in rows:
        grams = brute_buckets(text)
        want.append((i, sum(map(weight, grams)) / (len(grams) + quality.SHORT)))
    got = [(r.doc_id, r.score) for r in quality.quality_rules(docs, labels).collect()]
    key = lambda x: (x[0] is not None, x[0] or 0)
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-9)
    assert len({round(s, 3) for _, s in got}) > 20
