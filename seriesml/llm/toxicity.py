"""Toxicity: a factorization machine over hashed terms, fitted on a bounded sample of labelled documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesml.llm.common import documents, slices
from seriesml.session import materialise

_TERM = re.compile(r"\w+")
#: Terms are hashed into 2 ** TERM_BITS buckets; only the buckets that tell the labels apart have weights.
TERM_BITS = 40
#: The most terms with weights, and the smallest likelihood ratio of a term between its presence and the label.
MAX_TERMS, LEAST_RATIO = 512, 16.0
#: Terms whose places a Python worker keeps.
KEPT_TERMS = 200_000


def term_bucket(term: str) -> int:
    return xxhash.xxh64_intdigest(term) >> (64 - TERM_BITS)


def terms(text: str) -> set[str]:
    return set(_TERM.findall(text.lower()))


@dataclass(frozen=True)
class FactorizationMachine:
    """bias + sum of the weights of the terms present + sum over pairs of the products of their factors."""

    buckets: np.ndarray  # sorted
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def margins(self, present: list[np.ndarray]) -> np.ndarray:
        """One number for each document, from the places of its terms in `buckets`."""
        out = np.full(len(present), self.bias)
        for i, at in enumerate(present):
            if len(at):
                v = self.factors[at]
                out[i] += self.weights[at].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum())
        return out


def probabilities(margins: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margins, -35, 35)))


def _telling(docs: list[np.ndarray], y: np.ndarray, max_terms: int, least: float) -> np.ndarray:
    """The buckets of three documents or more whose presence and label depend on each other, by the likelihood ratio."""
    flat = np.concatenate([np.unique(d) for d in docs]) if docs else np.zeros(0, dtype=np.int64)
    owner = np.repeat(y, [len(np.unique(d)) for d in docs])
    buckets, inverse, n = np.unique(flat, return_inverse=True, return_counts=True)
    pos = np.bincount(inverse, weights=owner, minlength=len(buckets))
    total, total_pos = len(y), y.sum()
    g = np.zeros(len(buckets))
    for seen, size, share in ((pos, n, total_pos / total), (n - pos, n, 1 - total_pos / total),
                              (total_pos - pos, total - n, total_pos / total), (total - n - total_pos + pos, total - n, 1 - total_pos / total)):
        expected = size * share
        g += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0)
    good = np.flatnonzero((n >= 3) & (g >= least))
    return np.sort(buckets[good[np.argsort(-g[good], kind="stable")[:max_terms]]])


def fit_machine(docs: list[np.ndarray], labels, rank: int = 8, max_terms: int = MAX_TERMS, least: float = LEAST_RATIO, steps: int = 400,
                rate: float = 0.05, shrink: float = 1e-4, seed: int = 7) -> FactorizationMachine:
    """Fit by Adam on all rows at once; `docs` are arrays of buckets. With one label only, nothing but the bias is left.

    `max_terms` bounds the table of present terms (rows times terms); `least` is the smallest likelihood ratio of a term.
    """
    y = np.asarray(labels, dtype=np.float64)
    none = FactorizationMachine(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros((0, rank)), -5.0)
    if not len(y) or y.min() == y.max():
        return none if not len(y) or y.max() == 0 else FactorizationMachine(none.buckets, none.weights, none.factors, 5.0)
    buckets = _telling(docs, y, max_terms, least)
    x = np.zeros((len(y), len(buckets)), dtype=np.float32)
    for i, d in enumerate(docs):
        x[i, _places(buckets, d)] = 1
    rng = np.random.default_rng(seed)
    share = y.mean()
    p = {"b": np.array([np.log(share / (1 - share))]), "w": np.zeros(len(buckets)), "v": rng.normal(0, 0.05, (len(buckets), rank))}
    m = {k: np.zeros_like(a) for k, a in p.items()}
    s = {k: np.zeros_like(a) for k, a in p.items()}
    for t in range(1, steps + 1):
        v = p["v"].astype(np.float32)
        xv = x @ v
        margin = p["b"][0] + x @ p["w"].astype(np.float32) + 0.5 * ((xv ** 2).sum(axis=1) - x @ (v * v).sum(axis=1))
        error = ((probabilities(margin) - y) / len(y)).astype(np.float32)
        grad = {"b": np.array([error.sum()]), "w": x.T @ error + shrink * p["w"],
                "v": x.T @ (error[:, None] * xv) - (x.T @ error)[:, None] * v + 10 * shrink * p["v"]}
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            s[k] = 0.999 * s[k] + 0.001 * grad[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)
    return FactorizationMachine(buckets, p["w"], p["v"], float(p["b"][0]))


def _places(buckets: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(buckets):
        return np.zeros(0, dtype=np.int64)
    at = np.searchsorted(buckets, found)
    at[at == len(buckets)] = 0
    return np.unique(at[buckets[at] == found])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 0):
        found = [[term_bucket(t) for t in terms(x)] for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), batch.column(1)], names=["buckets", "label"])


def fold(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", **settings) -> FactorizationMachine:
    """Fit on at most `max_rows` labelled documents outside the held-out fold, taken in the order of a hash of the id.

    Of the sample only the presence of the telling terms reaches the driver. Labels NULL or without a
    document are left out; an id labelled several times counts once, as toxic if any label says so.
    """
    one = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    one = one.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = one.filter(fold() != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = documents(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("text", "label")
    hashed = materialise(rows.mapInArrow(_hashed, "buckets array<long>, label int"), "terms")
    found = telling_terms(hashed, **{k: settings[k] for k in ("max_terms", "least") if k in settings})
    present = F.array_intersect("buckets", F.lit(found).cast("array<bigint>")) if found else F.array().cast("array<bigint>")
    got = hashed.select(F.array_sort(present).alias("buckets"), "label").toPandas()
    order = sorted(range(len(got)), key=lambda i: (int(got["label"][i]), list(got["buckets"][i])))  # not by arrival
    return fit_machine([np.asarray(got["buckets"][i], dtype=np.int64) for i in order], [int(got["label"][i]) for i in order], **settings)


def telling_terms(hashed: DataFrame, max_terms: int = MAX_TERMS, least: float = LEAST_RATIO) -> list[int]:
    """Buckets of three documents or more whose presence and label depend on each other, the `max_terms` most telling.

    Documents are counted by bucket in Spark; only the chosen buckets reach the driver.
    """
    total, toxic = hashed.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic < total:
        return []
    counts = hashed.select(F.explode("buckets").alias("bucket"), "label").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("label").alias("pos"))
    n, pos, share = F.col("n"), F.col("pos"), toxic / total

    def part(seen, size, p):
        return F.when(seen > 0, 2 * seen * F.log(seen / (size * p))).otherwise(0.0)
    ratio = (part(pos, n, share) + part(n - pos, n, 1 - share) + part(toxic - pos, total - n, share)
             + part(total - n - toxic + pos, total - n, 1 - share))
    top = counts.filter(n >= 3).withColumn("ratio", ratio).filter(F.col("ratio") >= least).orderBy(F.desc("ratio"), "bucket").limit(max_terms)
    return sorted(r["bucket"] for r in top.collect())


class _Places(dict):
    """Term to its place among the weighted buckets, or -1."""

    def __init__(self, buckets: np.ndarray):
        super().__init__()
        self.at = {int(b): i for i, b in enumerate(buckets)}

    def __missing__(self, term: str) -> int:
        made = self[term] = self.at.get(term_bucket(term), -1)
        return made


def toxicity_score(text: F.Column, model: FactorizationMachine) -> F.Column:
    """Probability of label 1 for a text of any length; a NULL text scores as an empty one, by the bias alone."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        place = _Places(model.buckets)
        for texts in batches:
            present = []
            for text in texts:  # one text at a time as a Python string
                found = np.array([p for p in map(place.__getitem__, terms(text.as_py())) if p >= 0], dtype=np.int64)
                present.append(np.unique(found))
                if len(place) > KEPT_TERMS:
                    place.clear()
            yield pa.array(probabilities(model.margins(present)), pa.float64())
    return score(F.coalesce(text.cast("string"), F.lit("")))
