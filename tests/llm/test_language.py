import zlib

import numpy as np
from llm_data import documents, prose, texts

from crawlindex.llm import language


def sentence(seed, letters):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list(letters), rng.integers(2, 7))) for _ in range(40))


def corpus():
    kinds = {"xa": "abcdefg", "xb": "hijklmn", "xc": "abchijö"}
    return [
        (1000 * k + 100 + i, sentence(1000 * k + i, letters), name)
        for k, (name, letters) in enumerate(kinds.items())
        for i in range(60)
    ]


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus() + [(i, t, None) for i, t, _ in texts()] + [(9000, "1234 !!", "xa")]
    got = language.languages(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    lang = {i: name for i, _, name in corpus()}
    text = dict((i, t) for i, t, _ in rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id in lang:
            assert r.lang_pred == lang[r.doc_id]
        elif not any(c.isalpha() for c in text[r.doc_id] or ""):
            assert r.lang_pred == "und" and r.score == 0
        else:
            assert r.lang_pred in ("xa", "xb", "xc")


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, sentence(i, "abc"), "xa") for i in range(40)]
    wrong = [i for i in range(100, 400) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows += [(i, sentence(i, "xyz"), "xz") for i in wrong]
    assert language.fit(documents(spark, rows)).languages == ["xa"]


def test_probabilities_add_up_to_one():
    """Over all characters after a seen and an unseen context, for each model."""
    counts = {}
    for name, letters in (("xa", "abcd"), ("xb", "cdef")):
        keys = language.ngram_keys(language.encode(sentence(1, letters)))
        counts[name] = np.unique(keys, return_counts=True)
    models = language.build(counts)
    alphabet = [0, *map(ord, "abcdef")]
    for context in ("abc", "fff", "a a"):
        before = language.encode(context)
        base = models.log_probability(before)
        total = np.zeros(2)
        for code in alphabet:
            longer = np.append(before, np.uint64(code))
            total += np.exp(models.log_probability(longer) - base)
        unseen = np.exp(models.log_probability(np.append(before, np.uint64(0x4E00))) - base)
        assert np.allclose(total + unseen, 1, atol=1e-4)


def test_foreign_text_is_rejected(spark):
    rows = corpus() + [(5000, "ѣѥѩ" * 60, None), (5001, None, None)]
    kept = language.accepted_documents(documents(spark, rows))
    assert kept.columns == documents(spark).columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, _, _ in corpus()}


def test_without_labels_and_empty(spark):
    rows = [(1, prose(1, 20), None)]
    assert [r.lang_pred for r in language.languages(documents(spark, rows)).collect()] == ["und"]
    assert language.languages(documents(spark, [])).collect() == []


class Brute:
    """Interpolated Kneser-Ney by its definition, in dictionaries."""

    def __init__(self, codes, order=language.ORDER):
        from collections import Counter

        padded = [1] * (order - 1) + list(codes)
        grams = [tuple(padded[i : i + order]) for i in range(len(codes))]
        self.order, self.counts = order, {order: Counter(grams)}
        for n in range(order - 1, 0, -1):  # kinds of what comes before
            self.counts[n] = Counter(gram[1:] for gram in self.counts[n + 1])
        self.discount = {}
        for n, counts in self.counts.items():
            ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
            self.discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.5
        self.size = len(self.counts[1]) + 1

    def p(self, gram):
        n = len(gram)
        if not n:
            return 1 / self.size
        after = [c for g, c in self.counts[n].items() if g[:-1] == gram[:-1]]
        shorter = self.p(gram[1:])
        if not after:
            return shorter
        own, d = self.counts[n].get(gram, 0), self.discount[n]
        return (max(own - d, 0) + d * len(after) * shorter) / sum(after)

    def log_probability(self, codes):
        padded = [1] * (self.order - 1) + list(codes)
        grams = (tuple(padded[i : i + self.order]) for i in range(len(codes)))
        return sum(np.log(self.p(gram)) for gram in grams)


def counted(text):
    return np.unique(language.ngram_keys(language.encode(text)), return_counts=True)


def test_probabilities_equal_those_of_the_definition(monkeypatch):
    training = {"xa": sentence(1, "abcd"), "xb": sentence(2, "cdef"), "xc": sentence(3, "abcdefg")}
    brute = {name: Brute(language.encode(text).tolist()) for name, text in training.items()}
    alphabet = {c for b in brute.values() for (c,) in b.counts[1]}
    for b in brute.values():  # all share one alphabet and an unknown character
        b.size = len(alphabet) + 1
    for bound in (1 << 21, 1):  # one group, and one each
        monkeypatch.setattr(language, "GROUP_NUMBERS", bound)
        models = language.build({name: counted(text) for name, text in training.items()})
        assert len(models.groups) == (1 if bound > 1 else 3) and models.languages == ["xa", "xb", "xc"]
        for seed, letters in ((4, "abcd"), (5, "cdefg"), (6, "xyz")):
            codes = language.encode(sentence(seed, letters))[:60]
            want = [b.log_probability(codes.tolist()) for b in brute.values()]
            assert np.allclose(models.log_probability(codes), want, rtol=1e-4)


def test_three_hundred_languages_in_bounded_memory():
    """Tables hold the n-grams of all languages a few times, not once for each."""
    rng = np.random.default_rng(1)
    counts, grams = {}, 20_000
    for i in range(300):
        alphabet = rng.choice(np.arange(97, 700), 30, replace=False).astype(np.uint64)
        keys = np.zeros(grams, np.uint64)
        for letters in alphabet[rng.integers(0, 30, (language.ORDER, grams))]:
            keys = keys << np.uint64(16) | letters
        counts[f"l{i:03}"] = np.unique(keys, return_counts=True)
    models = language.build(counts)
    numbers = sum(group.numbers() for group in models.groups)
    assert models.languages == sorted(counts)
    # 164 million: some 27 for each n-gram. One table would hold 300 and more.
    assert numbers < 30 * 300 * grams
    assert max(group.numbers() for group in models.groups) < 6 * language.GROUP_NUMBERS
    text = "".join(chr(int(k & np.uint64(0xFFFF))) for k in counts["l123"][0][:300])
    assert models.classify(text)[0] in models.languages


def test_one_labelled_document_makes_a_language(spark):
    """Whatever share its id falls into."""
    for i in range(5001, 5012):
        if zlib.crc32(str(i).encode()) % 4 != 2:
            rows = [*corpus(), (i, sentence(77, "qrstuv"), "xq"), (i + 100, sentence(78, "qrstuv"), None)]
            docs = documents(spark, rows)
            got = {r.doc_id: r.lang_pred for r in language.languages(docs).collect()}
            assert got[i] == got[i + 100] == "xq"
            break
    models = language.fit(documents(spark, [(i, sentence(i, "abc"), f"l{i:03}") for i in range(300)]))
    known = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(300))
    assert len(models.languages) == known > 200


def syllables(seed, words, syllables_, n=120):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(syllables_, rng.integers(1, words))) for _ in range(n))


def test_unknown_latin_language_and_a_wrong_label(spark):
    """A text in a language of the same letters is rejected, also if one of the
    calibration documents carries a wrong label; clean ones stay."""
    kinds = {"xa": ["the", "an", "ing", "er", "on", "st"], "xb": ["sch", "en", "ung", "ie", "zu", "keit"]}
    rows = [
        (10_000 * k + i, syllables(10_000 * k + i, 4, own), name)
        for k, (name, own) in enumerate(kinds.items())
        for i in range(200)
    ]
    clean = {i for i, _, _ in rows}
    wrong = [(70_000 + i, syllables(i, 4, ["xq", "wv", "jk", "pz"]), "xa") for i in range(3)]
    foreign = [(80_000 + i, syllables(i, 4, ["uk", "vy", "aik", "oz", "pli", "qo"]), None) for i in range(20)]
    docs = documents(spark, rows + wrong + foreign)
    kept = {r.doc_id for r in language.accepted_documents(docs).select("doc_id").collect()}
    assert clean <= kept and not kept & {i for i, _, _ in foreign}


def test_too_many_labels_are_an_error(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 languages"):
        language.fit(documents(spark, corpus()))
