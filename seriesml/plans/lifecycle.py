"""Fit on recorded series, apply to new ones.

Stages are lazy DataFrame functions around small fitted objects, so clean … sequentialise run as one plan per action.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesml.config import Config
from seriesml.functions.columns import nan_to_null
from seriesml.operators import (
    attribution, clean, discriminant, encode, evaluate, features, importance, learners, neighbours, scale, sequence, split, tree_values, tuning)
from seriesml.operators.learners import CLASSIFICATION, REGRESSION
from seriesml.operators.ordering import SeriesLayout, series_layout
from seriesml.operators.split import seeded_key
from seriesml.session import materialise
from seriesml.sources.sinks import FeatureCatalogue
from seriesml.sources.sinks import write_cleaned as write_cleaned_rows


class Predictor(Protocol):
    """Adds a prediction to samples (series, `sample`, `x` as a flat array)."""

    def predict(self, samples: DataFrame, out: str) -> DataFrame: ...


@dataclass(frozen=True)
class VectorPredictor:
    """MLlib models, one per target step."""

    models: tuple

    def predict(self, samples: DataFrame, out: str) -> DataFrame:
        made = learners.with_vector(samples, "x")
        if len(self.models) == 1:
            return learners.predict(made, self.models[0], out).drop("features")
        return learners.MultiOutputModel(self.models).predict(made, out).drop("features")


@dataclass(frozen=True)
class ArrayPredictor:
    """Discriminants, and any other object with `predict(df, column, out)`."""

    model: Any

    def predict(self, samples: DataFrame, out: str) -> DataFrame:
        return self.model.predict(samples, "x", out)


@dataclass(frozen=True)
class NeighbourPredictor:
    model: neighbours.NeighbourModel
    classification: bool
    keys: tuple[str, ...]
    k: int = neighbours.K
    weights: str = "uniform"

    def predict(self, samples: DataFrame, out: str) -> DataFrame:
        # Rows multiplied by an explanation share their ids: each asked row gets a number, written once so that it stays.
        keyed = materialise(samples.withColumn("_sid", F.monotonically_increasing_id()), "asked")
        found = neighbours.neighbours(self.model, keyed, "_sid", "x", self.k)
        score = neighbours.classify if self.classification else neighbours.regress
        return keyed.join(score(found, "_sid", self.weights, out), "_sid").drop("_sid")


@dataclass(frozen=True)
class Fitted:
    """Everything inference needs: names, encodings, scalers and models."""

    config: Config
    series: tuple[str, ...]
    order: tuple[str, ...]
    catalogue: FeatureCatalogue
    raw_inputs: tuple[str, ...]
    encoding: encode.LabelEncoding | None
    input_scaler: scale.Scaler
    target_scaler: scale.Scaler
    predictors: Mapping[str, Predictor]
    metrics: DataFrame | None = None
    samples: DataFrame | None = None
    extras: Mapping[str, Any] = field(default_factory=dict)

    def transform(self, df: DataFrame, layout: SeriesLayout | None = None, original_units: bool = True) -> DataFrame:
        """(series, sample, method, y_pred) for new rows; the target may be absent."""
        keys = list(dict.fromkeys([*self.series, *self.order]))
        raw = clean.drop_target(nan_to_null(df), [c for c in self.catalogue.targets if c not in keys])
        raw = features.check_inputs(raw, [c for c in self.raw_inputs if c not in keys], keys)
        layout = layout or series_layout(raw, self.series, self.order)
        made = _engineered(raw, layout, self.config, ())
        ready = features.check_inputs(made, self.catalogue.inputs, keys).na.drop(subset=list(self.catalogue.inputs))
        ready = scale.apply_scaler(ready, self.input_scaler)
        seq = self.config.sequentialize
        samples = sequence.flatten_samples(
            sequence.input_sequences(ready, layout, self.catalogue.inputs, seq.window_size, seq.overlap))
        out = None
        for method, predictor in self.predictors.items():
            part = self._decoded(predictor.predict(samples, "y_pred"), original_units).select(
                *self.series, "sample", F.lit(method).alias("method"), "y_pred")
            out = part if out is None else out.unionByName(part)
        return out

    def _decoded(self, scored: DataFrame, original_units: bool) -> DataFrame:
        if self.config.clean.classification:
            return scored.withColumn("y_pred", F.col("y_pred").cast("int"))
        target = self.catalogue.targets[0]
        if not original_units or target not in self.target_scaler.centers:
            return scored
        if dict(scored.dtypes)["y_pred"].startswith("array"):
            return scored.withColumn("y_pred", F.transform("y_pred", lambda v: scale.unscaled(self.target_scaler, target, v)))
        return scored.withColumn("y_pred", scale.unscaled(self.target_scaler, target, F.col("y_pred")))


def _engineered(df: DataFrame, layout: SeriesLayout, config: Config, targets: Sequence[str]) -> DataFrame:
    keys = [*layout.series, *layout.order]
    fz = config.featurize
    base = features.booleans_to_int(features.numeric_only(df, [*keys, *targets]))
    if fz.use_all_engineered_features_on_all_variables:
        inputs = [c for c in base.columns if c not in keys and c not in targets]
        made = features.engineer_all(base, layout, inputs, fz.lengths())
    else:
        made = features.engineer(base, layout, fz.requests(), fz.lengths())
    return made.drop(*(fz.remove_features or []))


def write_cleaned(df: DataFrame, config: Config, series: Sequence[str], path: str, order: Sequence[str] = ()) -> FeatureCatalogue:
    """Write the cleaned rows, combined or by series as the configuration says; what was removed comes back."""
    cl = config.clean
    keys = list(dict.fromkeys([*series, *order]))
    table = nan_to_null(df)
    removed = [c for c in clean.removable_columns(table.drop(*[k for k in keys if k != cl.target]), cl.target, cl.percentage_zeros_threshold,
                                                  cl.input_max_correlation_threshold, cl.correlation_metric) if c not in keys]
    kept = clean.drop_missing(clean.drop_columns(table, removed))
    write_cleaned_rows(kept, path, cl, series)
    return FeatureCatalogue((cl.target,), tuple(c for c in kept.columns if c not in keys and c != cl.target), tuple(removed))


def _prepare(df: DataFrame, config: Config, series: Sequence[str], order: Sequence[str]):
    """Cleaned and engineered rows with the target first, and what cleaning and encoding decided."""
    cl = config.clean
    keys = list(dict.fromkeys([*series, *order]))
    table = nan_to_null(df)
    data = table.drop(*[k for k in keys if k != cl.target])
    removed = [c for c in clean.removable_columns(data, cl.target, cl.percentage_zeros_threshold,
                                                  cl.input_max_correlation_threshold, cl.correlation_metric) if c not in keys]
    table = clean.drop_missing(clean.drop_columns(table, removed))
    encoding = encode.fit_labels(table, cl.target) if cl.classification else None
    if encoding is not None:
        if cl.onehot_encode_target and encoding.binary:
            raise ValueError("one-hot encoding needs more than two classes")
        # One code column trains every learner; `one_hot` gives the separate columns when a table of them is wanted.
        table = encode.encode_label(table, encoding)
    table = features.select_variables(table, config.featurize.variables_to_include, [cl.target], keys)
    raw_inputs = tuple(c for c in table.columns if c not in keys and c != cl.target)
    layout = series_layout(table, series, order)
    made = _engineered(table, layout, config, [cl.target]).na.drop()
    inputs = [c for c in made.columns if c not in keys and c != cl.target]
    inputs = features.target_correlation_filter(made, cl.target, inputs, config.featurize.target_min_correlation_threshold)
    catalogue = FeatureCatalogue((cl.target,), tuple(inputs), tuple(removed))
    return made.select(*keys, cl.target, *inputs), layout, encoding, catalogue, raw_inputs


def _split(df: DataFrame, layout: SeriesLayout, config: Config) -> DataFrame:
    """One series is cut by rows, several by series."""
    sp, seed = config.split, config.train.seed
    one = not layout.series or df.select(*layout.series).distinct().limit(2).count() < 2
    if one and sp.shuffle_samples_before_split:
        return split.split_rows_shuffled(df, layout.series, layout.order, sp.train_split, seed)
    if one:
        return split.split_rows(df, layout, sp.train_split)
    if len(layout.series) != 1:
        raise ValueError("splitting by series needs one series column")
    return split.split_series(df, layout.series[0], sp.train_split, seed if sp.shuffle_files else None)


def make_samples(df: DataFrame, config: Config, series: Sequence[str], order: Sequence[str]):
    """Everything up to the flattened samples (series, sample, split, x, y), written once for training."""
    made, layout, encoding, catalogue, raw_inputs = _prepare(df, config, series, order)
    # Read by the scalers and by the samples, so the sorted windows behind it run once.
    parted = materialise(_split(made, layout, config), "features")
    train = parted.filter(F.col("split") == "train")
    inputs, target = list(catalogue.inputs), catalogue.targets[0]
    input_scaler = scale.fit_scaler(train, inputs, config.scale.input_method)
    target_scaler = scale.fit_target_scaler(train, [target], config.scale.output_method, config.clean.classification)
    ready = scale.apply_scaler(scale.apply_scaler(parted, input_scaler), target_scaler)
    sq = config.sequentialize
    steps = sequence.effective_target_size(sq.target_size, config.clean.classification)
    by_split = (series_layout(ready, [*series, "split"], order, layout.rows_per_task) if layout.sliced
                else SeriesLayout((*series, "split"), tuple(order), layout.rows_per_task))
    samples = sequence.flatten_samples(sequence.sequences(
        ready, by_split, inputs, [target], sq.window_size, steps, sq.overlap, sq.future_predict))
    if sq.shuffle_samples:  # the order matters to learners that go through the rows in batches
        samples = samples.orderBy(seeded_key([*series, "sample"], config.train.seed))
    samples = materialise(samples, "samples")
    return samples, steps, encoding, catalogue, raw_inputs, input_scaler, target_scaler


def _params(config: Config, method: str) -> dict:
    base = dict(config.train.params)
    if method == "dnn":
        t = config.train
        base = {"n_neurons": t.n_neurons, "n_layers": t.n_layers, "n_epochs": t.n_epochs, "batch_size": t.batch_size, **base}
    return base


def _fit_predictor(train: DataFrame, method: str, task: str, steps: int, config: Config, keys: Sequence[str]) -> Predictor:
    learners.check_method(method, task)
    params, seed = _params(config, method), config.train.seed
    classification = task == CLASSIFICATION
    labelled = train.withColumn("label", F.col("y")[0])
    if method == "lda":
        return ArrayPredictor(discriminant.fit_lda(labelled, "x", "label"))
    if method == "qda":
        return ArrayPredictor(discriminant.fit_qda(labelled, "x", "label"))
    if method in ("kn", "kneighbors"):
        if steps > 1:
            raise ValueError("nearest neighbours predict one step")
        keyed = labelled.withColumn("_sid", F.to_json(F.struct(*keys, "sample"), {"ignoreNullFields": "false"}))
        k, weights = params.get("n_neighbors", neighbours.K), params.get("weights", "uniform")
        if config.train.hyperparameter_tuning:
            best = tuning.search_neighbours(keyed, "_sid", "x", "label", task, seed=seed).first()
            k, weights = best["n_neighbors"], best["weights"]
        return NeighbourPredictor(neighbours.fit_neighbours(keyed, "_sid", "x", "label", k), classification, tuple(keys), k, weights)
    vectors = learners.with_vector(labelled, "x")
    if steps > 1:
        return VectorPredictor(learners.fit_multi_output(vectors, method, "y", steps, params, seed).models)
    if config.train.hyperparameter_tuning and method in ("rf", "xgboost", "xgb", "svm"):
        return VectorPredictor((tuning.random_search(vectors, method, task, seed=seed)[0],))
    return VectorPredictor((learners.fit(vectors, method, task, params, seed),))


def fit(df: DataFrame, config: Config, series: Sequence[str], order: Sequence[str]) -> Fitted:
    """Fit all stages and score the test samples."""
    samples, steps, encoding, catalogue, raw_inputs, input_scaler, target_scaler = make_samples(df, config, series, order)
    task = CLASSIFICATION if config.clean.classification else REGRESSION
    train = samples.filter(F.col("split") == "train")
    test = samples.filter(F.col("split") == "test")
    keys = list(series)
    if config.train.ensemble:
        if steps > 1:
            raise ValueError("the ensemble predicts one step")
        vectors = learners.with_vector(train.withColumn("label", F.col("y")[0]), "x")
        params = {m: _params(config, m) for m in learners.ENSEMBLE}
        models = learners.fit_ensemble(vectors, task, params, config.train.seed)
        predictors = {m: VectorPredictor((model,)) for m, model in models.items()}
    else:
        method = config.train.learning_method
        predictors = {method: _fit_predictor(train, method, task, steps, config, keys)}
    metrics = None
    for method, predictor in predictors.items():
        part = _metrics(predictor.predict(test, "y_pred"), task, steps).withColumn("method", F.lit(method))
        metrics = part if metrics is None else metrics.unionByName(part)
    return Fitted(config, tuple(series), tuple(order), catalogue, raw_inputs, encoding, input_scaler, target_scaler, predictors,
                  metrics, samples)


def _metrics(scored: DataFrame, task: str, steps: int) -> DataFrame:
    if steps > 1:
        return evaluate.regression_metrics_multi(scored, "y", "y_pred")
    pairs = scored.select(F.col("y")[0].alias("t"), F.col("y_pred").alias("p"))
    if task == CLASSIFICATION:
        return evaluate.classification_metrics(pairs, "t", "p")
    return evaluate.regression_metrics(pairs, "t", "p")


def scores(fitted: Fitted) -> DataFrame:
    """(model, score) in the metric of the configuration."""
    metric = "accuracy" if fitted.config.clean.classification else fitted.config.evaluate.performance_metric
    return fitted.metrics.select(F.concat(F.lit("model_"), "method").alias("model"), F.col(metric).alias("score"))


def explain(fitted: Fitted, spark) -> DataFrame:
    """(model, feature, importance) of every adequate model by the configured explanation methods.

    All test rows are explained against at most fifty weighted centres, unless the configuration sets a number of rows
    (a seeded sample) or of centres.
    """
    cfg = fitted.config
    names = sequence.flat_names(fitted.catalogue.inputs, cfg.sequentialize.window_size)
    ids = [*fitted.series, "sample"]

    def flat(df: DataFrame) -> DataFrame:
        return df.select(*ids, *[F.col("x")[i].alias(n) for i, n in enumerate(names)])

    train = flat(fitted.samples.filter(F.col("split") == "train"))
    tested, rows = fitted.samples.filter(F.col("split") == "test"), cfg.explain.number_of_summary_samples
    test = flat(tested if rows is None else split.sample_rows(tested, ids, rows, cfg.explain.seed))
    metric = "accuracy" if cfg.clean.classification else "r2"
    keep = {r["model"] for r in evaluate.adequate_models(
        scores(fitted), metric, cfg.evaluate.threshold_for_ensemble_models).collect()}
    kinds = ("shap", "lime") if cfg.explain.explanation_method == "all" else (cfg.explain.explanation_method,)
    background = attribution.kmeans_background(train, names, cfg.explain.number_of_background_samples or attribution.BACKGROUND_CENTRES, cfg.explain.seed)
    out = None
    for method, predictor in fitted.predictors.items():
        if f"model_{method}" not in keep:
            continue

        def score(rows: DataFrame, p=predictor) -> DataFrame:
            return p.predict(rows.withColumn("x", F.array(*names)), "y_pred").drop("x")
        for kind in kinds:
            trees = cfg.explain.shapley_mode == "exact" and isinstance(predictor, VectorPredictor) and len(predictor.models) == 1 and tree_values.is_supported(predictor.models[0])
            values = (tree_values.tree_shapley_values(test, ids, names, background, predictor.models[0]) if kind == "shap" and trees
                      else attribution.shapley_values(test, ids, names, background, score, seed=cfg.explain.seed, mode=cfg.explain.shapley_mode) if kind == "shap"
                      else attribution.local_surrogate(test, ids, names, train, score, seed=cfg.explain.seed))
            part = importance.global_importance(values).withColumn("model", F.lit(f"feature_importance_{kind}_{method}"))
            out = part if out is None else out.unionByName(part)
    return importance.normalise(out) if out is not None else None


def combined(fitted: Fitted, importances: DataFrame) -> DataFrame:
    """One importance for each feature over the explained models, as the configuration combines and weights them."""
    how = fitted.config.combine_explanations
    return importance.combine_importances(importances, scores(fitted), how.combination_method, how.weighting_method)


def agreement(fitted: Fitted, importances: DataFrame) -> DataFrame:
    """Mean agreement of the explained models by the configured correlation."""
    models = importance.complete_models(importances)
    return importance.agreement_score(importance.agreement_matrix(importances, models, fitted.config.combine_explanations.agreement_method))


def uncertainty(fitted: Fitted) -> DataFrame:
    """(ids, y_true, y_pred, y_unc, …) of the test samples from models fitted on resamples of the training samples.

    Regression gives the deviation of the draws and the 95 % band, classification the entropy of the draws. The number
    of draws is a setting.
    """
    cfg = fitted.config
    if cfg.train.ensemble or cfg.train.learning_method not in learners.LEARNERS:
        raise ValueError("uncertainty needs a single learner that can be refitted")
    ids = [*fitted.series, "sample"]
    method, draws = cfg.train.learning_method, cfg.evaluate.uncertainty_estimation_sampling_size
    vectors = learners.with_vector(fitted.samples.withColumn("label", F.col("y")[0]), "x")
    train, test = vectors.filter(F.col("split") == "train"), vectors.filter(F.col("split") == "test")
    truth = test.select(*ids, F.col("label").alias("y_true"))
    params = _params(cfg, method)
    if cfg.clean.classification:
        got = learners.bootstrap_probabilities(train, test.drop("label"), ids, method, draws, params, cfg.train.seed)
        mean = got.groupBy(*ids, "class").agg(F.avg("prob").alias("_p"))
        best = mean.groupBy(*ids).agg(F.max_by("class", F.struct("_p", -F.col("class"))).alias("y_pred"))
        return truth.join(best, ids).join(evaluate.sample_entropy(got, ids, "class", "prob"), ids)
    got = learners.bootstrap_draws(train, test.drop("label"), ids, method, REGRESSION, draws, params, cfg.train.seed)
    return truth.join(evaluate.prediction_band(evaluate.draw_summary(got, ids, "y_pred"), "y_pred", "y_unc"), ids)
