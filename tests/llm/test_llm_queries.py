"""The registered queries and the pipeline on the smallest given tables."""

import zlib
from collections import defaultdict

import pytest
from llm_data import documents
from test_simhash import brute_components, brute_fingerprint

import __spark_entry__ as entry
import corpus_pipeline
from crawlindex.llm import language, pii, quality, queries
from crawlindex.llm.bpe import codec

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = sorted(int(n[2 : n.index("_")]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= entry.queries().keys()


@pytest.mark.parametrize("name", queries.QUERIES)
def test_rows_of_the_whole_table(spark, name):
    result = queries.QUERIES[name](spark, SF_DIR)
    rows = result.collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    if name.startswith(("op3", "op4", "op6", "op7", "op10", "op11", "op13")):
        assert sorted(r.doc_id for r in rows) == sorted(docs)
    elif name.startswith("op1_"):
        assert {r.doc_id for r in rows} == docs
    else:
        assert rows


def test_pipeline_against_brute_force(spark):
    """Each stage's decisions, worked out row by row from its predecessor's."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(docs, labels).collect()}
    rows = {r.doc_id: r for r in docs.collect() if verdict[r.doc_id]}
    kept = spark.createDataFrame(list(rows.values()), docs.schema)
    models = language.fit(kept)
    rows = {i: r for i, r in rows.items() if models.classify(r.text)[2]}
    prints = {i: brute_fingerprint(r.text) for i, r in rows.items()}
    roots = brute_components(prints.values())
    least = {}
    for i in sorted(rows):
        least.setdefault(roots[prints[i]], i)
    rows = {i: rows[i] for i in least.values()}
    single = spark.createDataFrame(list(rows.values()), docs.schema)
    potentials = pii.fit(single)
    tokens = {}
    for i, r in rows.items():
        base = pii.base_spans(r.text)
        text = pii.redacted(r.text, base + pii.added_spans(r.text, base, potentials))
        tokens[i] = [*codec().encode(text).tolist(), 1]
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        pieces[r.doc_id].append(r)
    assert pieces.keys() == tokens.keys()
    for i, parts in pieces.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            data = b"".join(x.to_bytes(4, "little") for x in tokens[i][at : at + p.length])
            assert p.start == at and p.ids_crc32 == zlib.crc32(data)
            at += p.length
        assert at == len(tokens[i]) == parts[0].doc_tokens


def test_pipeline_gives_whole_training_sequences(spark):
    """The ids of all pieces, which fill the sequences at their places."""
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    sequences, documents_ = defaultdict(dict), defaultdict(dict)
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        sequences[r.sequence_id][r.offset] = r.ids
        documents_[r.doc_id][r.start] = r.ids
    for parts in sequences.values():
        at = 0
        for offset in sorted(parts):
            assert offset == at
            at += len(parts[offset]) // 4
        assert at <= 2048
    for parts in documents_.values():
        assert b"".join(parts[k] for k in sorted(parts))[-4:] == (1).to_bytes(4, "little")
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows, clashing names; no rows."""
    for docs in (documents(spark), documents(spark, [])):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
