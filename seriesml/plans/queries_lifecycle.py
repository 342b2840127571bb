"""Whole runs: fitted on the events, scored, applied and explained. Least squares makes every answer a closed form."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesml.config import Config
from seriesml.functions.columns import rounded
from seriesml.operators.resampling import POISSON_ONE
from seriesml.plans import lifecycle, saved
from seriesml.plans.registry import ORACLES, ev, query
from seriesml.session import scratch_path

# Two inputs of three values each; the first 70 % of the rows train.
_FIT = """WITH {ev},
o AS (SELECT value AS y, CAST(k % 3 AS DOUBLE) AS a, CAST(event_id % 3 AS DOUBLE) AS b, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM ev),
s AS (SELECT *, i < floor(n * 0.7) AS train FROM o),
c AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM s WHERE train),
m AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM c),
p AS (SELECT s.*, my + wa * (a - ma) + wb * (b - mb) AS p, wa * (a - ma) AS va, wb * (b - mb) AS vb FROM s, m),
g AS (SELECT avg(abs(va)) AS ga, avg(abs(vb)) AS gb FROM p WHERE NOT train)"""


def _rows(spark, sf):
    return ev(spark, sf).select("ts", "event_id", F.col("value").alias("y"), (F.col("k") % 3).cast("double").alias("a"),
                                (F.col("event_id") % 3).cast("double").alias("b"))


def _fitted(spark, sf):
    config = Config.from_mapping({
        "clean": {"target": "y"}, "split": {"train_split": 0.7}, "scale": {"input_method": None}, "sequentialize": {"window_size": 1},
        "train": {"learning_method": "linearregression"}, "evaluate": {"threshold_for_ensemble_models": -1000},
        "explain": {"explanation_method": "shap", "shapley_mode": "exact"}})
    return lifecycle.fit(_rows(spark, sf), config, [], ["ts", "event_id"])


@query("lifecycle_fit_metrics", _FIT + """ SELECT 'linearregression' AS method, count(*) AS n, round(avg((y - p) * (y - p)), 4) AS mse,
round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) + 0.0 AS r2 FROM p WHERE NOT train""")
def lifecycle_fit_metrics(spark, sf):
    got = _fitted(spark, sf).metrics
    return got.select("method", "n", rounded("mse", 4).alias("mse"), rounded("rmse", 4).alias("rmse"), rounded("r2").alias("r2"))


@query("lifecycle_transform", _FIT + " SELECT i AS sample, 'linearregression' AS method, round(p, 5) AS y_pred FROM p")
def lifecycle_transform(spark, sf):
    got = _fitted(spark, sf).transform(_rows(spark, sf).drop("y"))
    return got.select(F.col("sample").cast("long").alias("sample"), "method", rounded("y_pred", 5).alias("y_pred"))


_SHARES = " SELECT {model}'a' AS feature, round(ga / (ga + gb), 5) AS importance FROM g UNION ALL SELECT {model}'b', round(gb / (ga + gb), 5) FROM g"


@query("lifecycle_explain", _FIT + _SHARES.replace("{model}", "'feature_importance_shap_linearregression' AS model, "))
def lifecycle_explain(spark, sf):
    got = lifecycle.explain(_fitted(spark, sf), spark)
    return got.select("model", "feature", rounded("importance", 5).alias("importance"))


@query("lifecycle_combined", _FIT + _SHARES.replace("{model}", ""))
def lifecycle_combined(spark, sf):
    fitted = _fitted(spark, sf)
    got = lifecycle.combined(fitted, lifecycle.explain(fitted, spark))
    return got.select("feature", rounded("importance", 5).alias("importance"))


@query("lifecycle_saved", ORACLES["lifecycle_transform"])
def lifecycle_saved(spark, sf):
    """Saved, loaded and applied to rows that name the model."""
    root = scratch_path(spark, "models")
    saved.save_fitted(_fitted(spark, sf), spark, root, "events")
    got = saved.predict_saved(spark, root, _rows(spark, sf).drop("y").withColumn("model_id", F.lit("events")))
    return got.select(F.col("sample").cast("long").alias("sample"), "method", rounded("y_pred", 5).alias("y_pred"))


# A resample weighs a training sample by a hash of its number, the draw and the seed.
_DRAWS = f""", x AS (SELECT i, y, a, b FROM s WHERE train),
u AS (SELECT x.*, draw, CAST(('0x' || md5(i || ':' || draw || ':0')[1:8]) AS BIGINT) / 4294967296.0 AS u FROM x, range(0, 100) r(draw)),
w AS (SELECT *, {' + '.join(f'CAST(u >= {p} AS INTEGER)' for p in POISSON_ONE)} AS w FROM u),
e AS (SELECT draw, sum(w) AS n, sum(w * a) / sum(w) AS ma, sum(w * b) / sum(w) AS mb, sum(w * y) / sum(w) AS my, sum(w * a * a) / sum(w) AS aa,
  sum(w * b * b) / sum(w) AS bb, sum(w * a * b) / sum(w) AS ab, sum(w * a * y) / sum(w) AS ay, sum(w * b * y) / sum(w) AS yb FROM w GROUP BY draw),
f AS (SELECT draw, ma, mb, my, aa - ma * ma AS aa, bb - mb * mb AS bb, ab - ma * mb AS ab, ay - ma * my AS ay, yb - mb * my AS yb FROM e),
l AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM f),
q AS (SELECT i, y, my + wa * (a - ma) + wb * (b - mb) AS p FROM (SELECT * FROM s WHERE NOT train) t, l)
SELECT i - (SELECT count(*) FROM x) AS sample, round(any_value(y), 4) AS y_true, round(avg(p), 4) AS y_pred, round(stddev_pop(p), 4) AS y_unc FROM q GROUP BY i"""


@query("lifecycle_uncertainty", _FIT + _DRAWS)
def lifecycle_uncertainty(spark, sf):
    """Mean and deviation of a hundred resampled fits for each test sample."""
    got = lifecycle.uncertainty(_fitted(spark, sf))
    return got.select(F.col("sample").cast("long").alias("sample"), *[rounded(c, 4).alias(c) for c in ("y_true", "y_pred", "y_unc")])
