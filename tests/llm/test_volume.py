"""What the text operators shuffle, write and keep."""

import gc

import numpy as np
import pyarrow as pa
from conftest import prose

from seriesml.llm import line_dedup, lm_scoring, near_dedup, toxicity
from seriesml.llm.common import SLICE_BYTES


def test_only_lines_whose_variants_repeat_are_shuffled(make, rng, monkeypatch):
    written, through = {}, line_dedup.materialise

    def counted(df, name="table"):
        table = through(df, name)
        written.setdefault(name, []).append(table.count())
        return table
    monkeypatch.setattr(line_dedup, "materialise", counted)
    words = prose(rng, 400).split()
    rows = [(i, " ".join(words[:10] + [f"own{i}x{j}" for j in range(10)])) for i in range(30)]  # a half is shared, no variant is
    rows += [(40, " ".join(words[20:40])), (41, " ".join(words[20:39] + ["other"])), (42, " ".join(words[20:39]))]
    got = {r["doc_id"]: r["removed"] for r in line_dedup.repeated_lines(make(rows)).collect()}
    assert got == {41: [0], 42: [0]}
    assert sum(written["variants"]) > 600 and 0 < sum(written["met-variants"]) < 10


def test_workers_of_the_pipeline_forget_packed_words(spark, make, rng, tokenizer_path):
    import corpus_pipeline
    from pyspark.sql import functions as F

    @F.arrow_udf("long")
    def kept(a: pa.Array) -> pa.Array:
        held = [len(x.words) + len(x.pieces) for x in gc.get_objects() if type(x).__name__ == "Encoder" and hasattr(x, "pieces")]
        return pa.array([sum(held)] * len(a), pa.int64())
    docs = make([(i, prose(rng, 60)) for i in range(20)]).repartition(8)
    corpus_pipeline.pack_sequences(spark, docs, "").collect()
    after = spark.range(64).repartition(8).select(F.max(kept("id"))).first()[0]
    assert after == 0


def test_settled_classes_take_no_further_round(spark, monkeypatch):
    written, through = [], near_dedup.materialise
    monkeypatch.setattr(near_dedup, "materialise", lambda df, name="table": written.append(name) or through(df, name))
    links = through(spark.range(1, 40).selectExpr("id % 3 AS a", "id + 10 AS b"))
    got = {r["key"]: r["root"] for r in near_dedup.classes(links).collect()}
    assert got == {i + 10: i % 3 for i in range(1, 40)} | {0: 0, 1: 1, 2: 2}
    assert written == ["roots"]


def test_terms_are_hashed_a_slice_of_text_at_a_time():
    texts = ["word " * (SLICE_BYTES // 10)] * 6 + ["", "last"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([1] * 8, pa.int32())], names=["text", "label"])
    got = list(toxicity._hashed(iter([batch])))
    assert len(got) >= 3 and sum(b.num_rows for b in got) == 8
    one = toxicity.term_bucket("word")
    assert [x for b in got for x in b.column(0).to_pylist()] == [[one]] * 6 + [[], [toxicity.term_bucket("last")]]


def test_scores_do_not_depend_on_the_tokens_held(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = np.array([700, 0, 1, 2300])
    ids = rng.integers(0, 500, sizes.sum()).astype("<u2")
    around, logs = lm_scoring.contexts(ids, sizes), []
    for held in (1024, 37):
        monkeypatch.setattr(lm_scoring, "HELD", held)
        net = lm_scoring.Network.start()
        lm_scoring.train(net, ids, around, [np.full(p.shape, 1e-6, dtype=np.float32) for p in net.parts()])
        logs.append(lm_scoring.log_probabilities(net, ids, around))
    assert np.allclose(logs[0], logs[1], atol=1e-4) and logs[0].mean() > -10.3
