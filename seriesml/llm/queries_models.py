"""Queries of near duplicates, scores and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesml.llm import lm_scoring, near_dedup, quality_classifier, toxicity
from seriesml.llm.registry import query, table


@query("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark, sf):
    """The class of near copies of every document."""
    return near_dedup.near_duplicates(table(spark, sf, "documents")).select("doc_id", "class_id", "n_class")


@query("op10_toxicity")
def op10_toxicity(spark, sf):
    """Toxicity of every document; the held-out fold's labels are never read."""
    docs = table(spark, sf, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf, "labels"))
    scored = docs.select("doc_id", F.coalesce(toxicity.fold() == 0, F.lit(False)).alias("held_out"), toxicity.toxicity_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf):
    """Quality of every document from heuristic labellers alone."""
    return quality_classifier.quality_scores(table(spark, sf, "documents"))


@query("op1_lm_scoring")
def op1_lm_scoring(spark, sf):
    """Masked pseudo-likelihood of every document under a network trained on all of them."""
    return lm_scoring.pseudo_likelihood(table(spark, sf, "documents"))
