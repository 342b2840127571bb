"""From raw documents to packed token sequences: toxicity, repeated lines, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesml.llm.common import joined, keyed
from seriesml.llm.decontaminate import contamination
from seriesml.llm.line_dedup import repeated_lines, without_lines
from seriesml.llm.near_dedup import near_duplicates, one_of_each
from seriesml.llm.packing import Limits, packed_documents
from seriesml.llm.toxicity import fit_toxicity, toxicity_score
from seriesml.session import materialise

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity_score(F.col("text"), model) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stood in an earlier one; `n_chars` follows the text."""
    left = without_lines(docs, repeated_lines(docs))
    if "n_chars" not in left.columns:
        return left
    size = F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars"))
    return left.withColumn("n_chars", size)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return one_of_each(docs, materialise(near_duplicates(docs), "classes"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    rows, key = keyed(docs)
    bad = materialise(found.filter("contaminated").select(F.col("key").alias(key)).distinct(), "contaminated")
    return joined(rows, bad, [key], "left_anti").drop(key)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 tokens."""
    return packed_documents(docs, TOKENIZER, end_id=0, limits=Limits(tokens=2048), cached=100_000, forget=True)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("packing", pack_sequences)]
# A fitted classifier decides in the first stage, which SQL cannot express; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
