"""NULLs, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator."""

import brute
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from seriesml.llm import decontaminate, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, quality_rules, secret_scan, token_files, toxicity
from seriesml.llm.catalogue import QUERIES
from seriesml.session import scratch_path


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, key string, words string")


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, text string")


def tokens(spark, docs, path):
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, folder, path, 2)
    return token_files.read_tokens(spark, folder)


RUNS = {
    "op1": lambda s, d, p: lm_scoring.pseudo_likelihood(d),
    "op2": lambda s, d, p: token_files.checksums(tokens(s, d, p)),
    "op3": lambda s, d, p: quality_classifier.quality_scores(d),
    "op4": lambda s, d, p: near_dedup.near_duplicates(d),
    "op5": lambda s, d, p: quality_rules.judged(d),
    "op6": lambda s, d, p: line_dedup.without_lines(d, line_dedup.repeated_lines(d)),
    "op8": lambda s, d, p: secret_scan.secret_spans(d),
    "op9": lambda s, d, p: decontaminate.contamination(d, items(s, [(1, "a b c", "k", "w"), (None, "word", "k", "w"), (2, None, "k", "w")])),
    "op10": lambda s, d, p: d.select("doc_id", toxicity.toxicity_score(d["text"], toxicity.fit_toxicity(d, labelled(s, [(4, 1, "x"), (5, 0, None), (7, None, "x"), (None, 1, "")]))).alias("score")),
}


@pytest.mark.parametrize("name", RUNS)
def test_odd_rows_keep_their_place(spark, make, odd_rows, tokenizer_path, name):
    got = RUNS[name](spark, make(odd_rows), tokenizer_path).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in odd_rows)


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(spark, make, tokenizer_path, name):
    assert RUNS[name](spark, make([]), tokenizer_path).collect() == []


def test_pieces_of_odd_rows(spark, make, odd_rows, tokenizer_path):
    got = packing.packed_documents(make(odd_rows), tokenizer_path, 0, packing.Limits(tokens=256)).collect()
    order = lambda r: tuple(str(x) for x in r)
    want = brute.piece_rows(odd_rows, Tokenizer.from_file(tokenizer_path), 0, 256)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    assert brute.packed_fault([(r["sequence_id"], r["offset"], r["length"]) for r in got], 256) is None
    assert packing.packed_documents(make([]), tokenizer_path, 0).collect() == []


def test_tokens_of_odd_rows(spark, make, odd_rows, tokenizer_path):
    got = RUNS["op2"](spark, make(odd_rows), tokenizer_path).collect()
    want = brute.token_rows(odd_rows, Tokenizer.from_file(tokenizer_path), 2)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want


def test_values_of_odd_rows(spark, make, odd_rows):
    docs = make(odd_rows)
    lm = {r["doc_id"]: r for r in RUNS["op1"](spark, docs, None).collect()}
    assert lm[1]["n_tokens"] == 0 and lm[1]["log_likelihood"] == 0 and lm[1]["mean_log"] is None
    same = {r["doc_id"]: (r["class_id"], r["n_class"]) for r in RUNS["op4"](spark, docs, None).collect()}
    assert same[5] == same[6] == (5, 3) and same[1] == (1, 1) and same[2] == (2, 1)
    rules = {r["doc_id"]: r for r in RUNS["op5"](spark, docs, None).collect()}
    for i, text in odd_rows:
        if i is not None:
            r = rules[i]
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.rule_measures(text)
    lines = {r["doc_id"]: r["text"] for r in RUNS["op6"](spark, docs, None).collect()}
    assert lines[1] is None and lines[2] == "" and lines[10] == "the very same line of many words again" and lines[4] == "word"
    assert lines[5] == dict(odd_rows)[5] and lines[6] == ""
    hits = {r["doc_id"]: r for r in RUNS["op9"](spark, docs, None).collect()}
    assert hits[4]["n_hit"] == 1 and hits[1]["n_words"] == 0 and not hits[1]["contaminated"]


def test_without_labels_nothing_is_toxic(spark, make):
    docs = make([(1, "some words"), (2, "")])
    model = toxicity.fit_toxicity(docs, labelled(spark, []))
    assert all(r[0] < 0.5 for r in docs.select(toxicity.toxicity_score(docs["text"], model)).collect())


def test_empty_benchmark(spark, make):
    got = decontaminate.contamination(make([(1, "a b c")]), items(spark, [])).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in got] == [(3, 0, False)]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns(spark, make, odd_rows, tmp_path, name, stage):
    spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labelled(spark, [(4, 0, "")]).write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (odd_rows, []):
        docs = make(rows)
        got = stage(spark, docs, str(tmp_path))
        assert got.schema.names == docs.schema.names and got.dtypes == docs.dtypes
        n = got.count()
        assert n == len(rows) - (2 if name == "near_dedup" and rows else 0)


def test_rows_without_an_id_are_not_held_out(spark, make, tmp_path):
    make([(1, "a b"), (None, "c"), (10, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    labelled(spark, [(1, 1, "")]).write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op10_toxicity", "op11_language_id"):
        got = {r["doc_id"]: r["held_out"] for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert got[None] is False and all(isinstance(x, bool) for x in got.values())
