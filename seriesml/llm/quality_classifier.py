"""Quality without labels: heuristic labellers, their accuracies by expectation-maximisation, a hashed linear scorer."""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesml.llm.common import documents, row_key
from seriesml.session import materialise

_SYMBOLS, _UPPER, _MARKS = re.compile(r"[#*$%&|<>{}\\^~]+"), re.compile(r"[A-Z]"), re.compile(r"[^\w\s]")


def _vote(value: float, good: float, bad: float) -> int:
    """1 for good, -1 for bad, 0 between; the smaller value is the better."""
    return 1 if value <= good else -1 if value >= bad else 0


def _measures(text: str) -> tuple[list[str], dict[str, float]]:
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    again = sum(map(operator.eq, words, words[1:]))
    runs = _SYMBOLS.findall(text)
    return words, {
        "symbols": sum(map(len, runs)) / max(len(text), 1), "runs": len(runs) / n, "marks": len(_MARKS.findall(text)) / max(len(text), 1), "capitals": len(_UPPER.findall(text)) / max(len(text), 1), "shouting": text.count("!") / n,
        "again": again / n, "few_words": 1 - len(set(words)) / min(n, 400), "lines": 1 - len(set(lines)) / max(len(lines), 1),
        "odd_length": abs(len(text) / n - 6.5), "unpunctuated": 1 - min(1.0, 25 * text.count(".") / n), "n": float(len(words))}


#: name: (measure, at most: good, at least: bad). Labellers overlap and may abstain; none of them is trusted as it is.
LABELLERS = {
    "symbols": ("symbols", 0.01, 0.05), "runs": ("runs", 0.05, 0.3), "marks": ("marks", 0.06, 0.1), "capitals": ("capitals", 0.12, 0.35), "shouting": ("shouting", 0.05, 0.3), "again": ("again", 0.05, 0.3),
    "few_words": ("few_words", 0.75, 0.8), "lines": ("lines", 0.1, 0.4), "word_length": ("odd_length", 2.0, 4.0), "sentences": ("unpunctuated", 0.3, 0.9),
}
#: Shares of characters say nothing bad about texts of fewer than ENOUGH words.
SHARES, ENOUGH = ("marks", "capitals", "word_length"), 40


def votes(text: str) -> list[int]:
    """One vote of each labeller. A text without words is bad for all that can tell."""
    return _votes(*_measures(text))


def _votes(words: list[str], m: dict[str, float]) -> list[int]:
    if not words:
        return [-1] * len(LABELLERS)
    found = [_vote(m[k], good, bad) for k, good, bad in LABELLERS.values()]
    return [0 if v < 0 and name in SHARES and len(words) < ENOUGH else v for v, name in zip(found, LABELLERS)]


@dataclass(frozen=True)
class WeakLabels:
    """Share of good documents, and P(vote | class, the labeller votes) for the votes -1, 0, 1; axis 1 is the class, 1 for good.

    Abstaining says nothing: its entry is 1.
    """

    prior: float
    tables: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        log = np.log(np.array([1 - self.prior, self.prior])) + sum(
            np.log(self.tables[j][:, patterns[:, j] + 1]).T for j in range(patterns.shape[1]))
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        return p[:, 1] / p.sum(axis=1)


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0) -> WeakLabels:
    """Expectation-maximisation over vote patterns with counts, from the number of bad votes.

    Labellers are independent given the class. `smooth` votes of each kind are added, so a table is never 0. Classes keep
    their names since the start says that each bad vote makes a document worse; bad documents of different kinds, on which
    most labellers find nothing, then begin in one class.
    """
    n = patterns.shape[1] if patterns.ndim == 2 else 0
    if not len(patterns):
        return WeakLabels(0.5, np.full((n, 2, 3), 1.0))
    post = 0.95 * 0.3 ** (patterns < 0).sum(axis=1)
    model = WeakLabels(0.5, np.full((n, 2, 3), 1.0))
    for _ in range(rounds):
        tables = np.full((n, 2, 3), float(smooth))
        for j in range(n):
            for c, weight in enumerate((counts * (1 - post), counts * post)):
                tables[j, c] += np.bincount(patterns[:, j] + 1, weights=weight, minlength=3)
        tables /= tables[:, :, [0, 2]].sum(axis=2, keepdims=True)
        tables[:, :, 1] = 1.0
        model = WeakLabels(float(np.clip((counts * post).sum() / counts.sum(), 1e-4, 1 - 1e-4)), tables)
        new = model.posterior(patterns)
        if np.abs(new - post).max() < 1e-7:
            break
        post = new
    return model


#: The scorer's table has 2 ** SCORE_BITS weights.
SCORE_BITS = 18


class _Buckets(dict):
    """Word to the buckets of its shape and of itself."""

    def __missing__(self, word: str) -> tuple[int, int]:
        shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", re.sub(r"\d", "0", word)))
        made = self[word] = tuple(xxhash.xxh64_intdigest(x) >> (64 - SCORE_BITS) for x in ("shape " + shape, "word " + word.lower()))
        return made


_BUCKETS = _Buckets()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: shapes and words by their share of the text, repetition and length by steps."""
    return _features(*_measures(text))


def _features(words: list[str], m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    if len(_BUCKETS) > 300_000:
        _BUCKETS.clear()
    pairs = np.array(list(map(_BUCKETS.__getitem__, words)), dtype=np.int64).reshape(-1, 2)
    found, counts = np.unique(pairs.ravel(), return_counts=True)
    steps = [f"{k} {int(10 * min(m[k], 3.0))}" for k in ("symbols", "runs", "marks", "capitals", "shouting", "again", "few_words", "lines", "odd_length")]
    steps.append(f"length {min(int(np.log2(m['n'] + 1)), 16)}")
    own = np.array([xxhash.xxh64_intdigest(s) >> (64 - SCORE_BITS) for s in steps], dtype=np.int64)
    return np.concatenate([found, own]), np.concatenate([np.sqrt(counts / max(len(words), 1)), np.full(len(own), 0.5)])


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 8, rate: float = 0.3, seed: int = 3) -> np.ndarray:
    """Weights and, last, the bias of a logistic model of soft labels, by AdaGrad over shuffled rows."""
    weights, squares = np.zeros((1 << SCORE_BITS) + 1), np.full((1 << SCORE_BITS) + 1, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            error = 1 / (1 + np.exp(-np.clip(weights[at] @ x + weights[-1], -30, 30))) - target[i]
            grad = error * x
            np.add.at(squares, at, grad * grad)
            np.add.at(weights, at, -rate * grad / np.sqrt(squares[at]))
            squares[-1] += error * error
            weights[-1] -= rate * error / np.sqrt(squares[-1])
    return weights.astype(np.float32)


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [votes(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["key", "doc_id", "votes"])


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in made], pa.list_(pa.int64())),
                                          pa.array([x for _, x in made], pa.list_(pa.float64()))], names=["posterior", "at", "x"])


def quality_scores(docs: DataFrame, max_rows: int = 5_000, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, posterior (of the votes), score (of the hashed scorer), kept for every row.

    Votes of all documents are counted by pattern (3 to the number of labellers at most); accuracies follow from the
    counts. The scorer is fitted on at most `max_rows` documents in the order of a hash, with their posteriors as labels;
    only these reach the driver, as hashed features. A NULL or empty text has no words and scores by its length alone.
    """
    df = documents(docs, id_col, text_col).select(row_key().alias("key"), "doc_id", "text")
    kind = dict(df.dtypes)["doc_id"]
    voted = materialise(df.mapInArrow(_voted, f"key long, doc_id {kind}, votes array<int>"), "votes")
    counted = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    patterns = np.array([r["votes"] for r in counted], dtype=np.int64).reshape(-1, len(LABELLERS))
    model = fit_labels(patterns, np.array([r["n"] for r in counted], dtype=float))
    spark = docs.sparkSession
    posterior = spark.createDataFrame(pd.DataFrame({"votes": patterns.tolist(), "posterior": model.posterior(patterns) if len(patterns) else []}),
                                      "votes array<int>, posterior double")  # one row for each pattern
    labelled = voted.join(F.broadcast(posterior), "votes")
    chosen = labelled.groupBy("key").agg(F.first("posterior").alias("posterior")).orderBy(F.xxhash64("key"), "key").limit(max_rows)
    sample = df.join(F.broadcast(chosen), "key").dropDuplicates(["key"]).select("key", "posterior", "text")
    got = sample.orderBy("key").select("posterior", "text").mapInArrow(_described, "posterior double, at array<long>, x array<double>").toPandas()
    weights = fit_scorer([(np.asarray(a, dtype=np.int64), np.asarray(x)) for a, x in zip(got["at"], got["x"])], got["posterior"].to_numpy())
    table = spark.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = table.value
        tables = {tuple(p): q for p, q in zip(patterns.tolist(), model.posterior(patterns))}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            score, post = [], []
            for t in texts:
                words, m = _measures(t)
                at, x = _features(words, m)
                score.append(1 / (1 + np.exp(-np.clip(float(w[at] @ x) + float(w[-1]), -30, 30))))
                post.append(float(tables[tuple(_votes(words, m))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(post, pa.float64()), pa.array(score, pa.float64())], names=["doc_id", "posterior", "score"])
    made = df.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, posterior double, score double")
    return made.withColumn("kept", F.col("score") >= threshold)
