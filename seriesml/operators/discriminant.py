"""Linear and quadratic discriminant analysis from one pass of class sums.

Each task reduces its rows to counts, sums and cross products per class; only those reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ClassSums:
    label: float
    n: int
    mean: np.ndarray
    scatter: np.ndarray


def class_sums(df: DataFrame, x: str, label: str) -> list[ClassSums]:
    """Count, mean and centred cross products per class of an array column; sums are shifted for accuracy."""
    rows = df.select(F.col(label).cast("double").alias("label"), F.col(x).cast("array<double>").alias("x"))
    first = rows.first()
    if first is None:
        raise ValueError("no training rows")
    width = len(first["x"])
    shift = np.asarray(first["x"], dtype=float)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[float, list] = {}
        for pdf in batches:
            for cls, part in pdf.groupby("label"):
                m = np.stack(part["x"].to_numpy()) - shift
                got = sums.setdefault(cls, [0.0, np.zeros(width), np.zeros((width, width))])
                got[0] += len(m)
                got[1] += m.sum(axis=0)
                got[2] += m.T @ m
        for cls, (n, s, g) in sums.items():
            yield pd.DataFrame({"label": [cls], "cells": [np.concatenate([[n], s, g.ravel()])]})

    parts = rows.mapInPandas(partial, "label double, cells array<double>")
    merged = (parts.select("label", F.posexplode("cells").alias("pos", "v")).groupBy("label", "pos")
              .agg(F.sum("v").alias("v")).groupBy("label")
              .agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("cells"))
              .select("label", F.transform("cells", lambda c: c["v"]).alias("cells")).orderBy("label"))
    out = []
    for r in merged.collect():
        cells = np.asarray(r["cells"])
        n, s, g = cells[0], cells[1:1 + width], cells[1 + width:].reshape(width, width)
        mean = s / n
        out.append(ClassSums(r["label"], int(n), mean + shift, g - n * np.outer(mean, mean)))
    return out


@dataclass(frozen=True)
class LinearDiscriminant:
    """Score of class c: coef[c] . x + intercept[c]."""

    classes: tuple[float, ...]
    coef: np.ndarray
    intercept: np.ndarray

    def scores(self, x: str) -> Column:
        return F.array(*[
            F.aggregate(F.zip_with(F.col(x), F.lit(w), lambda a, b: a * b), F.lit(float(b)), lambda s, v: s + v)
            for w, b in zip(self.coef, self.intercept)])

    def predict(self, df: DataFrame, x: str, out: str = "y_pred") -> DataFrame:
        at = F.array_position("_scores", F.array_max("_scores")).cast("int")
        made = df.withColumn("_scores", self.scores(x))
        return made.withColumn(out, F.element_at(F.lit(np.asarray(self.classes)), at)).drop("_scores")


def fit_lda(df: DataFrame, x: str, label: str) -> LinearDiscriminant:
    """Classes share the pooled covariance (divided by rows minus classes); priors are class shares."""
    sums = class_sums(df, x, label)
    total = sum(c.n for c in sums)
    pooled = sum(c.scatter for c in sums) / (total - len(sums))
    inverse = np.linalg.pinv(pooled, hermitian=True)
    coef = np.stack([inverse @ c.mean for c in sums])
    intercept = np.array([-0.5 * c.mean @ w + np.log(c.n / total) for c, w in zip(sums, coef)])
    return LinearDiscriminant(tuple(c.label for c in sums), coef, intercept)


@dataclass(frozen=True)
class QuadraticDiscriminant:
    """Score of class c: constant[c] - |root[c] (x - mean[c])|^2 / 2."""

    classes: tuple[float, ...]
    means: np.ndarray
    roots: tuple[np.ndarray, ...]
    constants: np.ndarray

    def predict(self, df: DataFrame, x: str, out: str = "y_pred") -> DataFrame:
        classes, means, roots, constants = np.asarray(self.classes), self.means, self.roots, self.constants

        @F.pandas_udf("double")
        def best(rows: pd.Series) -> pd.Series:
            m = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, means.shape[1]))
            scores = np.stack([k - 0.5 * (((m - mu) @ r) ** 2).sum(axis=1) for mu, r, k in zip(means, roots, constants)], axis=1)
            return pd.Series(classes[scores.argmax(axis=1)])

        return df.withColumn(out, best(F.col(x).cast("array<double>")))


def fit_qda(df: DataFrame, x: str, label: str) -> QuadraticDiscriminant:
    """Each class has its own covariance (divided by its rows minus one)."""
    sums = class_sums(df, x, label)
    total = sum(c.n for c in sums)
    roots, constants = [], []
    for c in sums:
        values, vectors = np.linalg.eigh(c.scatter / (c.n - 1))
        keep = values > values.max() * 1e-12
        roots.append(vectors[:, keep] / np.sqrt(values[keep]))
        constants.append(np.log(c.n / total) - 0.5 * np.log(values[keep]).sum())
    return QuadraticDiscriminant(tuple(c.label for c in sums), np.stack([c.mean for c in sums]), tuple(roots), np.array(constants))
