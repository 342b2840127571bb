"""Every query of the text operators against its SQL or, where there is none, against plain Python over the whole tables."""

import hashlib

import brute
import duckdb
import pytest
from check import compare, oracle_connection
from tokenizers import Tokenizer

import __spark_entry__
from seriesml.llm.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return oracle_connection(data)


@pytest.fixture(scope="module")
def texts(data):
    return duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, data, name, *columns):
    return [tuple(r[c] for c in columns) for r in QUERIES[name](spark, data).collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, data, name):
    assert compare(QUERIES[name](spark, data), con, ORACLES[name]) == []


def test_names_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def test_token_files(spark, data, texts, tokenizer_path):
    want = brute.token_rows(texts, Tokenizer.from_file(tokenizer_path), 2)
    assert sorted(rows(spark, data, "op2_token_files", "doc_id", "start", "n_tokens", "ids_crc32")) == want


def test_packing(spark, data, texts, tokenizer_path):
    got = rows(spark, data, "op7_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    assert sorted(r[:5] for r in got) == sorted(brute.piece_rows(texts, Tokenizer.from_file(tokenizer_path), 0, 2048))
    assert brute.packed_fault([(r[5], r[6], r[3]) for r in got], 2048) is None
    total = sum(r[3] for r in got)
    assert len({r[5] for r in got}) <= -(-total // 2048) + 2


def test_secret_scans(spark, data, texts):
    got = {r[0]: r[1:] for r in rows(spark, data, "op8_secret_scans", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
    assert len(got) == len(texts)
    for i, text in texts:
        base = brute.spans_of(text)
        kinds = [s.split(":")[0] for s in base.split(",")]
        assert got[i][:3] == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert got[i][3] == hashlib.sha256(base.encode()).hexdigest()
        assert [s for s in got[i][4].split(",") if s and not s.startswith("markov")] == [s for s in base.split(",") if s]


def test_near_duplicates(spark, data, texts):
    got = rows(spark, data, "op4_minhash_near_dedup", "doc_id", "class_id", "n_class")
    want = brute.near_classes(texts)
    assert {i: c for i, c, _ in got} == want
    assert all(n == sum(c == d for d in want.values()) for _, c, n in got)


def test_toxicity_of_the_held_out_fold(spark, data):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{data.replace('sf0.001', 'sf0.1')}/labels.parquet'").fetchall())
    got = rows(spark, data.replace("sf0.001", "sf0.1"), "op10_toxicity", "doc_id", "held_out", "score", "predicted")
    held = [(s, p, labels[i]) for i, h, s, p in got if h and i in labels]
    assert all(p == (s >= 0.5) for s, p, _ in held) and all(0 <= s <= 1 for _, _, s, _ in got)
    positives, negatives = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in positives for b in negatives) / (len(positives) * len(negatives))
    assert auc > 0.95
    assert sum(p for _, p, y in held if not y) <= 0.01 * len(negatives)
    assert sum(p for _, p, y in held if y) >= 0.8 * len(positives)


def test_quality_without_labels(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall())
    got = [(k, labels[i]) for i, k in rows(spark, folder, "op3_quality_classifier", "doc_id", "kept") if i in labels]
    assert sum(k for k, y in got if y) >= 0.98 * sum(y for _, y in got)
    assert sum(k for k, y in got if not y) <= 0.15 * sum(not y for _, y in got)


def test_language_model_prefers_prose(spark, data):
    got = rows(spark, data.replace("sf0.001", "sf0.01"), "op1_lm_scoring", "doc_id", "n_tokens", "log_likelihood", "mean_log")
    assert len(got) == 1000
    assert all(s < 0 and abs(m - s / n) < 1e-9 for _, n, s, m in got if n)
