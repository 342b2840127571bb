"""The pipeline against a plain version of all its stages."""

import brute
import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from seriesml.llm import line_dedup, toxicity


@pytest.fixture(scope="module")
def packed(spark, data):
    return corpus_pipeline.run(spark, data).collect()


def test_rows(spark, data, packed, tokenizer_path):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet' ORDER BY doc_id").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{data}/benchmark.parquet'").fetchall()
    model = toxicity.fit_toxicity(spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet"))

    def score(text):
        at = toxicity._places(model.buckets, np.array(sorted(map(toxicity.term_bucket, toxicity.terms(text or ""))), dtype=np.int64))
        return toxicity.probabilities(model.margins([at]))[0]
    rows = [(i, t) for i, t in rows if score(t) < 0.5]
    rows = sorted(brute.line_dedup(rows, line_dedup.MIN_CHARS, line_dedup.MIN_WORDS).items())
    classes = brute.near_classes(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    bad = {r[0] for r in brute.contaminated(rows, items) if r[-1]}
    rows = [(i, t) for i, t in rows if i not in bad]
    want = brute.piece_rows(rows, Tokenizer.from_file(tokenizer_path), 0, 2048)
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == sorted(want)


def test_sequences(packed):
    assert brute.packed_fault([(r["sequence_id"], r["offset"], r["length"]) for r in packed], 2048) is None


def test_stages_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
