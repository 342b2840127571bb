"""Randomised hyper-parameter search with cross-validation."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from itertools import product

import numpy as np
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesml.operators import learners, neighbours, resampling
from seriesml.operators.learners import CLASSIFICATION

# Search grids, tries and folds.
GRIDS = {
    "rf": {"max_depth": (2, 4, 6, 8), "n_estimators": (50, 100, 200, 400, 800, 1000),
           "min_samples_split": (2, 4, 6, 8, 10), "min_samples_leaf": (1, 3, 5)},
    "kn": {"n_neighbors": (2, 4, 5, 6, 10, 15, 20, 30), "weights": ("uniform", "distance")},
    "xgboost": {"max_depth": (2, 4, 6, 8), "n_estimators": (50, 100, 200, 400, 800, 1000),
                "learning_rate": (0.3, 0.1, 0.001, 0.0001)},
    "svm": {"max_iter": (1, 5, 10)},
}
TRIES = 10
FOLDS = 5

PARAM_NAMES = {"max_depth": "maxDepth", "n_estimators": ("numTrees", "maxIter"), "min_samples_leaf": "minInstancesPerNode",
               "learning_rate": "stepSize", "max_iter": "maxIter"}


def draw_candidates(grid: Mapping[str, Sequence], tries: int, seed: int) -> list[dict]:
    """Seeded choice of distinct grid points."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    return random.Random(seed).sample(points, min(tries, len(points)))


def _param(stage, name: str) -> Param | None:
    wanted = PARAM_NAMES.get(name, ())
    for w in (wanted,) if isinstance(wanted, str) else wanted:
        if stage.hasParam(w):
            return stage.getParam(w)
    return None


def _param_map(estimator, point: Mapping) -> dict:
    """MLlib parameters of a grid point. A split size of n rows means leaves of at least n / 2 rows."""
    stage = estimator.getClassifier() if hasattr(estimator, "getClassifier") else estimator
    out = {}
    for name, value in point.items():
        if name == "min_samples_split":
            continue
        found = _param(stage, name)
        if found is not None:
            out[found] = value
    leaf = max(point.get("min_samples_leaf", 1), point.get("min_samples_split", 2) // 2)
    if stage.hasParam("minInstancesPerNode") and ("min_samples_leaf" in point or "min_samples_split" in point):
        out[stage.getParam("minInstancesPerNode")] = leaf
    return out


def random_search(train: DataFrame, method: str, task: str, grid: Mapping[str, Sequence] | None = None, tries: int = TRIES,
                  folds: int = FOLDS, seed: int = 0, parallelism: int = 4) -> tuple[PipelineModel, DataFrame]:
    """Best model, and a table of the tried points with their mean score (accuracy or R2)."""
    data = train.select("features", F.col("label").cast("double").alias("label"))
    estimator = learners.build_estimator(method, task, learners.training_facts(data, task), None, seed)
    points = draw_candidates(grid or GRIDS[{"xgb": "xgboost"}.get(method, method)], tries, seed)
    evaluator = (MulticlassClassificationEvaluator(metricName="accuracy") if task == CLASSIFICATION
                 else RegressionEvaluator(metricName="r2"))
    search = CrossValidator(estimator=estimator, estimatorParamMaps=[_param_map(estimator, p) for p in points],
                            evaluator=evaluator, numFolds=folds, seed=seed, parallelism=parallelism)
    fitted = search.fit(data)
    rows = [(str(p), float(s)) for p, s in zip(points, fitted.avgMetrics)]
    table = train.sparkSession.createDataFrame(rows, "params string, score double").orderBy(F.desc("score"), "params")
    return PipelineModel([fitted.bestModel]), table


def search_neighbours(train: DataFrame, id: str, x: str, label: str, task: str, grid: Mapping[str, Sequence] | None = None,
                      folds: int = FOLDS, seed: int = 0) -> DataFrame:
    """Score of every (n_neighbors, weights) by cross-validation.

    The neighbours of a row for the largest k contain those for all smaller ones, so each fold is searched once.
    """
    grid = grid or GRIDS["kn"]
    largest = max(grid["n_neighbors"])
    parted = train.withColumn("_fold", F.pmod(F.xxhash64(id, F.lit(seed)), F.lit(folds)).cast("int"))
    found = None
    for f in range(folds):
        model = neighbours.fit_neighbours(parted.filter(F.col("_fold") != f), id, x, label, largest, seed=seed)
        got = neighbours.neighbours(model, parted.filter(F.col("_fold") == f), id, x)
        found = got if found is None else found.unionByName(got)
    found = found.persist()
    truth = train.select(id, F.col(label).cast("double").alias("_truth"))
    rows = []
    for k, weights in product(grid["n_neighbors"], grid["weights"]):
        some = found.filter(F.col("rank") <= k)
        pred = (neighbours.classify if task == CLASSIFICATION else neighbours.regress)(some, id, weights)
        pairs = pred.join(truth, id)
        if task == CLASSIFICATION:
            score = F.avg((F.col("y_pred") == F.col("_truth")).cast("double"))
        else:
            err = F.col("y_pred") - F.col("_truth")
            score = 1 - F.try_divide(F.sum(err * err), F.var_pop("_truth") * F.count("_truth"))
        rows.append((k, weights, float(pairs.agg(score.alias("s")).first()["s"])))
    found.unpersist()
    return train.sparkSession.createDataFrame(rows, "n_neighbors int, weights string, score double").orderBy(
        F.desc("score"), "n_neighbors", "weights")


def search_ridge(train: DataFrame, ids: Sequence[str], penalties: Sequence[float], folds: int = FOLDS, seed: int = 0) -> DataFrame:
    """(alpha, score): mean R2 over the folds of every ridge penalty, best first, from one pass over the table.

    A row's fold comes from a hash of its ids. The sums of all other folds train a penalty, and the held-out fold's own sums
    give its squared error, so folds and penalties share one scan.
    """
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids], F.lit(f"fold{seed}"))
    fold = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % folds
    member = F.transform(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: (fold == f).cast("double"))
    cells, _, _ = resampling.cross_products(train, member, folds)
    rows = []
    for alpha in penalties:
        scores = []
        for own in cells:
            others = cells.sum(axis=0) - own
            if not own[0, 0] or not others[0, 0]:
                continue
            b, at = resampling.solve(others, alpha)
            v = np.concatenate([[-at], -b, [1.0]])  # the error of a row is this combination of 1, features and label
            spread = own[-1, -1] - own[0, -1] ** 2 / own[0, 0]
            scores.append(1 - float(v @ own @ v) / float(spread) if spread > 0 else None)
        known = [x for x in scores if x is not None]
        rows.append((float(alpha), sum(known) / len(known) if known else None))
    return train.sparkSession.createDataFrame(rows, "alpha double, score double").orderBy(F.desc("score"), "alpha")
