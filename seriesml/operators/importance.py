"""Feature importances: aggregation of attributions, combination over models, and agreement between models.

Attributions are rows (sample, feature, value), importances are rows (model, feature, importance). A table of model
scores has one row per trained model, so windows over it are small by nature.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesml.functions.columns import correlation, method_suffix
from seriesml.operators.evaluate import rank_within

# Importances at or below this count as zero for agreement, and the lengths of the reports.
AGREEMENT_FLOOR = 0.02
TOP_IMPACT = 10
TOP_SUMMARY = 25


def global_importance(attributions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute attribution per feature."""
    return attributions.groupBy(*by, "feature").agg(F.avg(F.abs("value")).alias("importance"))


def normalise(importances: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Importances of a model as shares of their sum. A model has one row per feature."""
    total = F.sum("importance").over(Window.partitionBy(*by))
    return importances.withColumn("importance", F.try_divide(F.col("importance"), total))


def directional_importance(attributions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the positive parts and mean of the negative parts."""
    v = F.col("value")
    return attributions.groupBy(*by, "feature").agg(
        F.avg(F.greatest(v, F.lit(0.0))).alias("positive"), F.avg(F.least(v, F.lit(0.0))).alias("negative"))


def top_impact(directional: DataFrame, rows: int = TOP_IMPACT) -> DataFrame:
    """Features with the largest |positive| + |negative|."""
    impact = F.abs("positive") + F.abs("negative")
    return directional.withColumn("impact", impact).orderBy(F.desc("impact"), "feature").limit(rows)


def top_features(importances: DataFrame, rows: int = TOP_SUMMARY, by: Sequence[str] = ("model",)) -> DataFrame:
    return rank_within(importances, by, [F.desc("importance"), F.col("feature")], rows)


def importance_matrix(importances: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per model, one column per feature."""
    return importances.groupBy("model").pivot("feature", list(features)).agg(F.first("importance"))


def drop_incomplete_models(importances: DataFrame) -> DataFrame:
    """Leave out models that miss an importance: NULL, NaN, or no row for a feature that another model has."""
    there = F.col("importance").isNotNull() & ~F.isnan("importance")
    # A row for each model and feature, so one window over all of them is small by nature.
    known = F.size(F.collect_set(F.when(there, F.col("feature"))).over(Window.partitionBy("model")))
    every = F.size(F.collect_set("feature").over(Window.partitionBy()))
    marked = importances.withColumns({"_known": known, "_every": every})
    return marked.filter(F.col("_known") == F.col("_every")).drop("_known", "_every")


def keep_adequate(importances: DataFrame, adequate: DataFrame) -> DataFrame:
    """Importance rows of adequate models."""
    return importances.join(adequate, "model", "left_semi")


def drop_inadequate(importances: DataFrame, inadequate: DataFrame) -> DataFrame:
    return importances.join(inadequate, "model", "left_anti")


def _share(raw: Column) -> Column:
    return F.try_divide(raw, F.sum(raw).over(Window.partitionBy()))


def _normalize(s: Column) -> Column:
    return _share(s)


def _softmax(s: Column) -> Column:
    return _share(F.exp(s))


def _clip(s: Column) -> Column:
    return _share(F.greatest(s, F.lit(0.0)))


def _square(s: Column) -> Column:
    return _share(s * s)


def _zscore(s: Column) -> Column:
    w = Window.partitionBy()
    return F.try_divide(s - F.avg(s).over(w), F.stddev_samp(s).over(w))


def _minmax(s: Column) -> Column:
    w = Window.partitionBy()
    return F.try_divide(s - F.min(s).over(w), F.max(s).over(w) - F.min(s).over(w))


WEIGHTINGS: dict[str, Callable[[Column], Column]] = {
    "normalize": _normalize, "softmax": _softmax, "exponential": _softmax, "clip_negative": _clip,
    "square": _square, "zscore": _zscore, "minmax": _minmax,
}


def _average_rank(c: str | Column, w_order: Window, w_ties: Window) -> Column:
    return F.rank().over(w_order) + (F.count(F.lit(1)).over(w_ties) - 1) / 2.0


def model_weights(scores: DataFrame, method: str = "softmax", score: str = "score") -> DataFrame:
    """Add `weight`. Rank and logarithm need an intermediate column; an unknown method normalises."""
    everything = Window.partitionBy()
    if method == "rank":
        raw = _average_rank(score, Window.orderBy(score), Window.partitionBy(score))
        table = scores.withColumn("_raw", raw)
    elif method == "log":
        low = scores.withColumn("_low", F.min(score).over(everything))
        table = low.withColumn("_raw", F.log(F.col(score) + F.abs("_low") + 1)).drop("_low")
    else:
        return scores.withColumn("weight", WEIGHTINGS.get(method, _normalize)(F.col(score)))
    return table.withColumn("weight", F.try_divide(F.col("_raw"), F.sum("_raw").over(everything))).drop("_raw")


def combine_importances(importances: DataFrame, scores: DataFrame | None = None, method: str = "avg",
                        weighting: str = "softmax") -> DataFrame:
    """One importance per feature over all complete models, largest first.

    `weighted` multiplies each model's importances by the weight of the score with the same method suffix, takes the
    mean over models and rescales to sum 1; a model without a score keeps its values. Other methods take the mean.
    """
    complete = drop_incomplete_models(importances)
    if method not in ("weighted", "weight", "weights"):
        mean = complete.groupBy("feature").agg(F.avg("importance").alias("importance"))
        return mean.orderBy(F.desc("importance"), "feature")
    weights = model_weights(scores, weighting).select(method_suffix("model").alias("_method"), "weight")
    joined = complete.withColumn("_method", method_suffix("model")).join(weights, "_method", "left")
    value = F.col("importance") * F.coalesce("weight", F.lit(1.0))
    mean = joined.groupBy("feature").agg(F.avg(value).alias("_mean"))
    total = F.sum("_mean").over(Window.partitionBy())
    return (mean.select("feature", F.when(total != 0, F.col("_mean") / total).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))


def agreement_matrix(importances: DataFrame, models: Sequence[str], method: str = "spearman",
                     floor: float = AGREEMENT_FLOOR) -> DataFrame:
    """Correlation over features of each pair of models (model_a before model_b in the given order).

    Features become rows with one column per model, so all pairs are one aggregate and nothing is joined to itself.
    """
    cut = F.when(F.col("importance") > floor, F.col("importance")).otherwise(F.lit(0.0))
    rows = importances.select("model", "feature", cut.alias("_v"))
    if method == "spearman":
        ranked = _average_rank("_v", Window.partitionBy("model").orderBy("_v"), Window.partitionBy("model", "_v"))
        rows = rows.select("model", "feature", ranked.alias("_v"))
    wide = rows.groupBy("feature").pivot("model", list(models)).agg(F.first("_v"))
    pairs = list(combinations(models, 2))
    row = wide.agg(*[correlation(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(f"_{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)])))


def agreement_score(matrix: DataFrame) -> DataFrame:
    """Mean and population standard deviation over the pairs."""
    return matrix.agg(F.avg("correlation").alias("agreement"), F.stddev_pop("correlation").alias("agreement_std"))


def complete_models(importances: DataFrame) -> list[str]:
    """Names of the models without a missing importance: one name per trained model."""
    rows = drop_incomplete_models(importances).select("model").distinct().collect()
    return sorted(r[0] for r in rows)
