import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_data import documents, prose, texts
from tokenizers import Tokenizer

from crawlindex.llm import bpe, packing


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def odd_text(rng, n):
    makers = [
        lambda k: "".join(rng.choices("abcdefghij", k=k)),
        lambda k: " " * k,
        lambda k: "".join(rng.choices(" \n\t'sabcdé1234.,!<|endoftext|>", k=k)),
        lambda k: "a" * k + " " * (k // 3) + "1" * k + "'" * (k // 2) + "s" * k,
        lambda k: "".join(chr(rng.choice([0x4E00 + rng.randrange(2000), 0x1F600, 233, 32])) for _ in range(k)),
        lambda k: "<|endoftext|>" * (k // 13),
    ]
    return "".join(rng.choice(makers)(rng.randint(1, 400)) for _ in range(n))


def test_tree_concatenation_equals_the_library(library):
    rng, codec = random.Random(3), bpe.codec()
    for _ in range(150):
        text = odd_text(rng, rng.randint(1, 12))
        piece = rng.choice([50, 97, 300, 1000])
        cut = [text[i : i + piece] for i in range(0, len(text), piece)]
        ids = codec.concatenate([(c.encode(), codec.encode(c)) for c in cut])
        assert ids.tolist() == library(text)


def test_round_trip_equals_the_library(spark, library):
    got = bpe.round_trip(documents(spark)).collect()
    want = []
    for i, t, _ in texts():
        ids = np.array(library(t or ""), "<u4")
        digest = hashlib.sha256((t or "").encode()).hexdigest()
        want.append(str((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), digest)))
    assert sorted(str(tuple(r)) for r in got) == sorted(want)


def test_small_pieces_in_spark(spark, library):
    got = {r.doc_id: r.ids for r in bpe.encoded(documents(spark), piece=500).collect()}
    for i, t, _ in texts():
        assert np.frombuffer(got[i], "<u4").tolist() == library(t or "")


def test_decoding_unknown_and_broken_ids():
    codec = bpe.codec()
    assert codec.decode(np.array([10**6, *codec.encode("ab é")], np.uint32)) == "ab é"
    half = [i for i, s in codec._strings.items() if s == b"\xc3"]
    assert codec.decode(np.array(half, np.uint32)) == "�"


def check_packing(rows, ids_of, size):
    """Every id in just one piece, sequences gapless and never too long."""
    documents_, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents_[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, pieces in documents_.items():
        ids = ids_of[i]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            part = ids[p.start : p.start + p.length]
            assert p.start in (at, 0) and zlib.crc32(part.tobytes()) == p.ids_crc32
            assert p.doc_tokens == len(ids)
            at = p.start + p.length
        assert sum(p.length for p in pieces) % len(ids) == 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing(spark, library):
    rows = packing.packed(documents(spark)).collect()
    ids_of = {i: np.array([*library(t or ""), 1], "<u4") for i, t, _ in texts()}
    check_packing(rows, ids_of, 2048)
    assert sum(r.length for r in rows) == sum(len(library(t or "")) + 1 for _, t, _ in texts())


def test_many_equal_lengths_and_little_padding(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 50)
    rng = random.Random(1)
    rows = [(i, prose(i, rng.randint(5, 500)), "en") for i in range(150)]
    rows += [(1000 + i, "same words", "en") for i in range(300)]
    out = packing.packed(documents(spark, rows)).collect()
    check_packing(out, {i: np.array([*library(t), 1], "<u4") for i, t, _ in rows}, 2048)
    used = sum(r.length for r in out)
    assert used >= 0.97 * 2048 * (1 + max(r.sequence_id for r in out))


def test_patterns_hold_the_histogram():
    rng = random.Random(2)
    histogram = {n: rng.randint(1, 50) for n in rng.sample(range(1, 2048), 400)}
    found = defaultdict(int)
    for count, pattern in packing.patterns(histogram, 2048):
        assert sum(pattern) <= 2048
        for n in pattern:
            found[n] += count
    assert found == histogram


@pytest.mark.parametrize("length", [100, 200, 300, 682, 683, 900])
def test_a_third_of_equal_middling_rests_is_no_padding(length):
    rng = random.Random(3)
    histogram = defaultdict(int)
    for _ in range(40_000):
        histogram[rng.randint(1, 2048)] += 1
    for spread in (histogram, {}):
        histogram = {**spread, length: spread.get(length, 0) + 20_000}
        found = defaultdict(int)
        for count, pattern in packing.patterns(histogram, 2048):
            assert sum(pattern) <= 2048
            for n in pattern:
                found[n] += count
        assert found == histogram
        packs = sum(count for count, _ in packing.patterns(histogram, 2048))
        needed = sum(n * count for n, count in histogram.items()) / 2048
        if 2048 // length == 2:  # two at most of these in a pack, and one longer
            alone = sum(c for n, c in histogram.items() if n > 2048 - length)
            pairs = sum(c for n, c in histogram.items() if length <= n <= 2048 - length)
            needed = max(needed, alone + pairs / 2)
        if spread:
            assert packs <= 1.02 * needed
        else:
            assert packs == -(-20_000 // (2048 // length))


def test_equal_rests_get_places_of_their_own():
    histogram = {300: 1000, 299: 7, 20: 40}
    taken = defaultdict(list)
    for length, first, count, sequence, offset, times in packing.slots(histogram, 2048):
        for turn in range(count * times):
            at = offset + turn // count * length
            taken[sequence + turn % count].append((at, at + length))
    assert sum(map(len, taken.values())) == 1047
    for spans in taken.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 2048
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_empty_table(spark):
    assert bpe.round_trip(documents(spark, [])).collect() == []
    assert packing.packed(documents(spark, [])).collect() == []
