"""Learners by name, distributed with MLlib, and the fits that share a table.

A learner name maps to the tasks it serves and a function building its estimator. Training tables carry their
features as a vector column `features` and a double column `label`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesml.operators import resampling

REGRESSION, CLASSIFICATION = "regression", "classification"

# Names of the ensemble members, sizes and penalties of the learners.
ENSEMBLE = ("dt", "rf", "gb", "xgb", "sgd", "lgbm")
FOREST_TREES = 100
BOOSTING = {"gb": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1},
            "xgb": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3},
            "lgbm": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1}}
RIDGE_ALPHA = LASSO_ALPHA = ELASTIC_ALPHA = 1.0
ELASTIC_L1 = 0.5
SGD_ALPHA = 1e-4
# The deepest tree of MLlib: trees grow fully unless `max_depth` says otherwise.
TREE_DEPTH = 30


@dataclass(frozen=True)
class TrainingFacts:
    """What an estimator needs to know about the table: rows, label spread, classes and features."""

    rows: int
    label_std: float
    classes: int
    features: int


def with_vector(df: DataFrame, features: str | Sequence[str], out: str = "features") -> DataFrame:
    """Features as a vector: from an array column, or from numeric columns."""
    if isinstance(features, str):
        if isinstance(df.schema[features].dataType, T.ArrayType):
            return df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))
        features = [features]
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def training_facts(df: DataFrame, task: str) -> TrainingFacts:
    top = F.max("label") if task == CLASSIFICATION else F.lit(0.0)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s"), top.alias("c")).first()
    first = df.select("features").first()
    return TrainingFacts(row["n"], row["s"] or 0.0, int(row["c"] or 0) + 1, len(first["features"]) if first else 0)


def _linear(facts: TrainingFacts, alpha: float, l1: float, params: Mapping) -> Estimator:
    """Least squares plus `alpha` penalties in original units, un-penalised intercept, no standardisation.

    MLlib scales the label by its deviation s and the whole penalty with it, which keeps L1 but divides L2 by s; the
    two parameters are set so that both come out as asked.
    """
    s = facts.label_std
    common = {"standardization": False, "maxIter": params.get("max_iter", 1000), "tol": 1e-10}
    if alpha == 0 or s == 0:
        return LinearRegression(regParam=0.0, standardization=False, solver="normal" if facts.features <= 4096 else "l-bfgs")
    lasso, ridge = alpha * l1, alpha * (1 - l1)
    if lasso == 0:
        # MLlib takes the mean squared loss; `alpha` belongs to the sum over rows.
        return LinearRegression(regParam=ridge * s / facts.rows, elasticNetParam=0.0, standardization=False,
                                solver="normal" if facts.features <= 4096 else "l-bfgs")
    total = lasso + s * ridge
    return LinearRegression(regParam=total, elasticNetParam=lasso / total, **common)


def _per_class(classifier: Estimator, facts: TrainingFacts) -> Estimator:
    """Binary classifiers serve more classes one against the rest."""
    return classifier if facts.classes <= 2 else OneVsRest(classifier=classifier, parallelism=min(facts.classes, 4))


def _tree(task, facts, params, seed):
    cls = DecisionTreeClassifier if task == CLASSIFICATION else DecisionTreeRegressor
    return cls(maxDepth=params.get("max_depth", TREE_DEPTH), seed=seed,
               minInstancesPerNode=params.get("min_samples_leaf", 1))


def _forest(task, facts, params, seed):
    cls = RandomForestClassifier if task == CLASSIFICATION else RandomForestRegressor
    return cls(numTrees=params.get("n_estimators", FOREST_TREES), maxDepth=params.get("max_depth", TREE_DEPTH), seed=seed,
               minInstancesPerNode=params.get("min_samples_leaf", 1), bootstrap=params.get("bootstrap", True),
               featureSubsetStrategy="sqrt" if task == CLASSIFICATION else "all")


def _boosting(flavour):
    def build(task, facts, params, seed):
        base = BOOSTING[flavour]
        args = {"maxIter": params.get("n_estimators", base["maxIter"]), "maxDepth": params.get("max_depth", base["maxDepth"]),
                "stepSize": params.get("learning_rate", base["stepSize"]), "seed": seed}
        return _per_class(GBTClassifier(**args), facts) if task == CLASSIFICATION else GBTRegressor(**args)
    return build


def _ols(task, facts, params, seed):
    return _linear(facts, 0.0, 0.0, params)


def _ridge(task, facts, params, seed):
    return _linear(facts, params.get("alpha", RIDGE_ALPHA), 0.0, params)


def _lasso(task, facts, params, seed):
    return _linear(facts, params.get("alpha", LASSO_ALPHA), 1.0, params)


def _elastic(task, facts, params, seed):
    return _linear(facts, params.get("alpha", ELASTIC_ALPHA), params.get("l1_ratio", ELASTIC_L1), params)


def _svc(task, facts, params, seed):
    return _per_class(LinearSVC(regParam=params.get("alpha", 1.0 / max(facts.rows, 1)), maxIter=params.get("max_iter", 100),
                                standardization=False), facts)


def _sgd(task, facts, params, seed):
    alpha = params.get("alpha", SGD_ALPHA)
    if task == CLASSIFICATION:
        return _svc(task, facts, {**params, "alpha": alpha}, seed)
    # The penalty is per row here, so it is multiplied by the rows to meet the sum in `_linear`.
    return _linear(facts, alpha * facts.rows, 0.0, params)


def _dense(task, facts, params, seed):
    hidden = params.get("n_neurons", [16])
    hidden = [hidden] * params.get("n_layers", 1) if isinstance(hidden, int) else list(hidden)
    return MultilayerPerceptronClassifier(layers=[facts.features, *hidden, max(facts.classes, 2)], seed=seed,
                                          maxIter=params.get("n_epochs", 100), blockSize=params.get("batch_size", 128))


@dataclass(frozen=True)
class Learner:
    build: Callable
    tasks: tuple[str, ...] = (REGRESSION, CLASSIFICATION)


LEARNERS: dict[str, Learner] = {
    "dt": Learner(_tree), "rf": Learner(_forest),
    "gb": Learner(_boosting("gb")), "gradientboosting": Learner(_boosting("gb")),
    "xgb": Learner(_boosting("xgb")), "xgboost": Learner(_boosting("xgb")), "lgbm": Learner(_boosting("lgbm")),
    "linearregression": Learner(_ols, (REGRESSION,)), "ridgeregression": Learner(_ridge, (REGRESSION,)),
    "lasso": Learner(_lasso, (REGRESSION,)), "elasticnet": Learner(_elastic, (REGRESSION,)),
    "sgd": Learner(_sgd), "svm": Learner(_svc, (CLASSIFICATION,)), "dnn": Learner(_dense, (CLASSIFICATION,)),
}
# Served by their own modules.
OWN_LEARNERS = {"lda": (CLASSIFICATION,), "qda": (CLASSIFICATION,),
                "kn": (REGRESSION, CLASSIFICATION), "kneighbors": (REGRESSION, CLASSIFICATION)}


def check_method(method: str, task: str) -> None:
    """A method has to be known and serve the task."""
    tasks = LEARNERS[method].tasks if method in LEARNERS else OWN_LEARNERS.get(method)
    if tasks is None:
        raise NotImplementedError(f"learning method {method} is not available")
    if task not in tasks:
        raise ValueError(f"learning method {method} only works with {' or '.join(tasks)}")


def build_estimator(method: str, task: str, facts: TrainingFacts, params: Mapping | None = None, seed: int = 0) -> Estimator:
    check_method(method, task)
    if method not in LEARNERS:
        raise ValueError(f"{method} has its own fit function")
    return LEARNERS[method].build(task, facts, dict(params or {}), seed)


def fit(train: DataFrame, method: str, task: str, params: Mapping | None = None, seed: int = 0) -> PipelineModel:
    """Fit one learner on (`features`, `label`)."""
    check_method(method, task)
    data = train.select("features", F.col("label").cast("double").alias("label"))
    return PipelineModel([build_estimator(method, task, training_facts(data, task), params, seed).fit(data)])


def fit_many(train: DataFrame, methods: Sequence[str], task: str, params: Mapping[str, Mapping] | None = None,
             seed: int = 0, parallelism: int = 3) -> dict[str, PipelineModel]:
    """Fit several learners on one cached table; fits run side by side, each as Spark jobs of its own."""
    for m in methods:
        check_method(m, task)
    data = train.select("features", F.col("label").cast("double").alias("label")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        facts = training_facts(data, task)
        with ThreadPoolExecutor(parallelism) as pool:
            jobs = {m: pool.submit(build_estimator(m, task, facts, (params or {}).get(m), seed).fit, data) for m in methods}
            return {m: PipelineModel([j.result()]) for m, j in jobs.items()}
    finally:
        data.unpersist()


def fit_ensemble(train: DataFrame, task: str, params: Mapping[str, Mapping] | None = None, seed: int = 0) -> dict[str, PipelineModel]:
    return fit_many(train, ENSEMBLE, task, params, seed)


def predict(df: DataFrame, model: Model, out: str = "y_pred") -> DataFrame:
    """Add the prediction; helper columns of the model are dropped."""
    made = model.transform(df).withColumnRenamed("prediction", out)
    return made.select(*df.columns, out)


def predict_many(df: DataFrame, models: Mapping[str, Model], ids: Sequence[str]) -> DataFrame:
    """(ids, method, y_pred) of every model: one scan, each model adding a column before the unpivot."""
    out = df
    for name, model in models.items():
        out = predict(out, model, f"_pred_{name}")
    cells = [F.struct(F.lit(n).alias("method"), F.col(f"_pred_{n}").alias("y_pred")) for n in models]
    return out.select(*ids, F.inline(F.array(*cells)))


@dataclass(frozen=True)
class MultiOutputModel:
    """One model per target step."""

    models: tuple[PipelineModel, ...] = field(default_factory=tuple)

    def predict(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        made = df
        for i, m in enumerate(self.models):
            made = predict(made, m, f"_step_{i}")
        return made.select(*df.columns, F.array(*[f"_step_{i}" for i in range(len(self.models))]).alias(out))


def fit_multi_output(train: DataFrame, method: str, target: str, steps: int, params: Mapping | None = None, seed: int = 0,
                     parallelism: int = 3) -> MultiOutputModel:
    """One regression model per element of the array column `target`, on one cached table."""
    check_method(method, REGRESSION)
    data = train.select("features", target).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def one(i):
            return fit(data.select("features", F.col(target)[i].alias("label")), method, REGRESSION, params, seed)
        with ThreadPoolExecutor(parallelism) as pool:
            return MultiOutputModel(tuple(pool.map(one, range(steps))))
    finally:
        data.unpersist()


def tree_importances(model: PipelineModel, names: Sequence[str], spark) -> DataFrame:
    """Impurity importances by feature name, largest first. One row per feature."""
    tree = model.stages[-1]
    if hasattr(tree, "featureImportances"):
        values = tree.featureImportances.toArray()
    else:
        parts = [m.featureImportances.toArray() for m in tree.models]
        values = sum(parts) / len(parts)
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def linear_coefficients(model: PipelineModel) -> tuple[list[float], float]:
    stage = model.stages[-1]
    return [float(c) for c in stage.coefficients.toArray()], float(stage.intercept)


def resample(train: DataFrame, ids: Sequence[str], draw: int, seed: int = 0) -> DataFrame:
    """Each row as often as a Poisson number of mean 1 says, drawn from the row's ids alone: the same on any cluster."""
    counted = train.withColumn("_times", resampling.times(ids, F.lit(draw), seed)).filter("_times > 0")
    return counted.withColumn("_times", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def _bootstrap(train: DataFrame, ids: Sequence[str], method: str, task: str, draws: int, params: Mapping | None, seed: int, parallelism: int) -> list:
    """Models fitted on `draws` resamples of one cached table."""
    data = train.select(*ids, "features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            return list(pool.map(lambda i: fit(resample(data, ids, i, seed), method, task, params, seed + i), range(draws)))
    finally:
        data.unpersist()


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the tasks: each of them is worked on for every draw, and a few large files would make a few long tasks."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def bootstrap_draws(train: DataFrame, df: DataFrame, ids: Sequence[str], method: str, task: str, draws: int,
                    params: Mapping | None = None, seed: int = 0, parallelism: int = 3) -> DataFrame:
    """(ids, draw, y_pred): predictions of the resampled models.

    Least squares and ridge take one pass over the table for all draws, as long as their sums are few enough.
    """
    if task == REGRESSION and method in ("linearregression", "ridgeregression"):
        first = train.select("features").first()
        if first is not None and resampling.fits(draws, len(first["features"])):
            alpha = 0.0 if method == "linearregression" else float((params or {}).get("alpha", RIDGE_ALPHA))
            fitted = resampling.bootstrap_linear(_spread(train.select(*ids, "features", "label")), ids, draws, seed, alpha)
            return fitted.predict(_spread(df.select(*ids, "features")), ids)
    fitted = _bootstrap(train, ids, method, task, draws, params, seed, parallelism)
    got = predict_many(df, {str(i): m for i, m in enumerate(fitted)}, ids)
    return got.select(*ids, F.col("method").cast("int").alias("draw"), "y_pred")


def bootstrap_probabilities(train: DataFrame, df: DataFrame, ids: Sequence[str], method: str, draws: int,
                            params: Mapping | None = None, seed: int = 0, parallelism: int = 3) -> DataFrame:
    """(ids, draw, class, prob): class probabilities of the resampled models, for learners that give them."""
    fitted = _bootstrap(train, ids, method, CLASSIFICATION, draws, params, seed, parallelism)
    out = df
    for i, model in enumerate(fitted):
        made = model.transform(out)
        if "probability" not in made.columns:
            raise ValueError(f"learning method {method} gives no class probabilities")
        out = made.select(*out.columns, vector_to_array("probability").alias(f"_prob_{i}"))
    cells = [F.struct(F.lit(i).alias("draw"), F.col(f"_prob_{i}").alias("_p")) for i in range(draws)]
    return out.select(*ids, F.inline(F.array(*cells))).select(*ids, "draw", F.posexplode("_p").alias("class", "prob"))
