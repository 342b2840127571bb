"""Metrics, uncertainty and the data frames behind evaluation plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Floor of the MAPE divisor, offset of the entropy logarithm, width of the 95 % band, automatic floors.
MAPE_FLOOR = 2.220446049250313e-16
ENTROPY_OFFSET = 1e-15
BAND_WIDTH = 1.96
AUTO_THRESHOLDS = {"accuracy": 0.75, "r2": 0.5}


def _scores(truth: Column, pred: Column) -> dict[str, Column]:
    err = truth - pred
    mse = F.avg(err * err)
    rest = F.sum(err * err)
    # sum (y - mean)^2, from the population variance, which Spark accumulates stably.
    total = F.var_pop(truth) * F.count(truth)
    return {
        "mse": mse, "rmse": F.sqrt(mse),
        "mape": F.avg(F.abs(err) / F.greatest(F.lit(MAPE_FLOOR), F.abs(truth))),
        "r2": F.when(total == 0, F.when(rest == 0, 1.0).otherwise(0.0)).otherwise(1 - rest / total),
    }


def regression_metrics(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, MAPE and R2 of the complete pairs."""
    pairs = df.filter(F.col(truth).isNotNull() & F.col(pred).isNotNull())
    exprs = [e.alias(n) for n, e in _scores(F.col(truth).cast("double"), F.col(pred).cast("double")).items()]
    return pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *exprs)


def regression_metrics_multi(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """The same for array targets: each output on its own, then the plain mean over outputs."""
    steps = df.select(*by, F.posexplode(F.arrays_zip(F.col(truth).alias("t"), F.col(pred).alias("p"))))
    steps = steps.select(*by, F.col("pos").alias("_output"), F.col("col.t").alias("_t"), F.col("col.p").alias("_p"))
    each = regression_metrics(steps, "_t", "_p", [*by, "_output"])
    return each.groupBy(*by).agg(F.count(F.lit(1)).alias("n_outputs"),
                                 *[F.avg(m).alias(m) for m in ("mse", "rmse", "mape", "r2")])


def classification_metrics(df: DataFrame, truth: str, pred: str, by: Sequence[str] = (), positive: int = 1) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; a ratio with nothing to divide is 0."""
    t, p = F.col(truth) == positive, F.col(pred) == positive
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth) == F.col(pred)).alias("_hit"),
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.select(*by, "n", (F.col("_hit") / F.col("n")).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
                          ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def confusion_matrix(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Count and share of the true class for every (true, predicted) pair, zero cells included.

    Rows shrink to the sparse matrix first; the classes are then listed once per true class.
    """
    cells = df.groupBy(F.col(truth).alias("true_class"), F.col(pred).alias("pred_class")).agg(
        F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy("true_class").agg(
        F.map_from_entries(F.collect_list(F.struct("pred_class", "n"))).alias("_n"), F.sum("n").alias("_total"))
    classes = cells.select(F.explode(F.array("true_class", "pred_class")).alias("c")).agg(
        F.sort_array(F.collect_set("c")).alias("_classes"))
    every = (classes.select(F.explode("_classes").alias("true_class"), "_classes").join(rows, "true_class", "left")
             .select("true_class", "_n", "_total", F.explode("_classes").alias("pred_class")))
    n = F.coalesce(F.try_element_at(F.col("_n"), F.col("pred_class")), F.lit(0)).cast("long")
    return every.select("true_class", "pred_class", n.alias("n"),
                        F.coalesce(n / F.col("_total"), F.lit(0.0)).alias("share"))


def confusion_uncertainty(df: DataFrame, truth: str, pred: str, uncertainty: str) -> DataFrame:
    """Mean uncertainty per (true, predicted) pair that occurs."""
    return df.groupBy(F.col(truth).alias("true_class"), F.col(pred).alias("pred_class")).agg(
        F.avg(uncertainty).alias("mean_uncertainty"), F.count(F.lit(1)).alias("n"))


def draw_summary(draws: DataFrame, sample: Sequence[str], pred: str) -> DataFrame:
    """Mean and population standard deviation of the prediction draws of each sample."""
    return draws.groupBy(*sample).agg(F.avg(pred).alias("y_pred"), F.stddev_pop(pred).alias("y_unc"))


def _entropy_term(p: Column) -> Column:
    return -p * F.log(p + F.lit(ENTROPY_OFFSET))


def draw_entropy(draws: DataFrame, sample: Sequence[str], cls: str, prob: str) -> DataFrame:
    """Sum of -p ln p over the draws, per class of each sample, with the mean probability."""
    return draws.groupBy(*sample, cls).agg(F.sum(_entropy_term(F.col(prob))).alias("entropy"),
                                           F.avg(prob).alias("mean_prob"))


def sample_entropy(draws: DataFrame, sample: Sequence[str], cls: str, prob: str) -> DataFrame:
    """Mean over classes of the summed entropy."""
    return draw_entropy(draws, sample, cls, prob).groupBy(*sample).agg(F.avg("entropy").alias("y_unc"))


def predictive_entropy(draws: DataFrame, sample: Sequence[str], cls: str, prob: str) -> DataFrame:
    """Entropy of the mean class distribution."""
    mean = draws.groupBy(*sample, cls).agg(F.avg(prob).alias("_p"))
    return mean.groupBy(*sample).agg(F.sum(_entropy_term(F.col("_p"))).alias("y_unc"))


def prediction_band(df: DataFrame, pred: str, uncertainty: str, width: float = BAND_WIDTH) -> DataFrame:
    """Lower and upper end of the 95 % band."""
    half = F.lit(width) * F.col(uncertainty)
    return df.withColumn("lower", F.col(pred) - half).withColumn("upper", F.col(pred) + half)


def adequate_models(scores: DataFrame, metric: str = "r2", threshold: float | str = "auto", score: str = "score") -> DataFrame:
    """Models whose score reaches the threshold; `auto` takes the floor of the metric."""
    limit = AUTO_THRESHOLDS[metric] if threshold == "auto" else float(threshold)
    return scores.filter(F.col(score) >= limit)


def prediction_frame(truth: DataFrame, predictions: DataFrame, sample: Sequence[str], methods: Sequence[str],
                     x: str | None = None) -> DataFrame:
    """Truth beside one prediction column per method, joined by sample; with `x`, the inputs at the last step.

    `predictions` is (sample, method, y_pred); the methods are known, so the pivot needs no pass to find them.
    """
    wide = predictions.groupBy(*sample).agg(*[
        F.max(F.when(F.col("method") == m, F.col("y_pred"))).alias(f"pred_{m}") for m in methods])
    out = truth.join(wide, list(sample), "inner")
    return out.withColumn("last_inputs", F.element_at(F.col(x), -1)).drop(x) if x else out


def sequence_prediction_frame(df: DataFrame, index: str, truth: str, pred: str, target_size: int) -> DataFrame:
    """Every `target_size`-th sample, exploded to one row per predicted step; a shorter last sequence is dropped."""
    kept = df.filter((F.col(index) % target_size == 0) & (F.size(pred) == target_size))
    steps = kept.select(index, F.posexplode(F.arrays_zip(F.col(truth).alias("t"), F.col(pred).alias("p"))))
    return steps.select((F.col(index) + F.col("pos")).alias("step"), F.col("col.t").alias("y_true"),
                        F.col("col.p").alias("y_pred"))


def align_with_predictions(original: DataFrame, predictions: DataFrame, index: str, window: int) -> DataFrame:
    """Every `window`-th true value beside its prediction: the last ones when there are more values than predictions."""
    truth = original.filter(F.col(index) % window == 0).select(
        (F.col(index) / window).cast("long").alias("_at"), F.col("y_true"))
    sizes = truth.agg(F.count(F.lit(1)).alias("a")).first()["a"] - predictions.count()
    return predictions.join(truth.withColumn("sample", F.col("_at") - F.lit(max(sizes, 0))).drop("_at"), "sample")


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], rows: int) -> DataFrame:
    """The first `rows` rows of each group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= rows).drop("_rn")
