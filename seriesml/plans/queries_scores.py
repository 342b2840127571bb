"""Queries on predictions, scores, attributions, combined importances and emissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesml.functions.columns import method_suffix, rounded
from seriesml.operators import emissions, evaluate, importance, sequence
from seriesml.operators.ordering import over_series
from seriesml.functions.rolling import rolling_mean
from seriesml.plans.queries_series import _W, _ev_series, _samples_sql, one_series, users
from seriesml.plans.registry import ev, long, query, table


def _r(df, cols, digits=6):
    return df.select(*[rounded(c, digits).alias(c) if c in cols else c for c in df.columns])


# ---------------------------------------------------------------- metrics

_PRED = f"""WITH {{ev}}, p AS (SELECT *, CASE WHEN count(value) OVER w = 10 THEN avg(value) OVER w END AS pred FROM ev
WINDOW w AS ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""


def _predicted(spark, sf):
    df = ev(spark, sf).select("user_id", "ts", "event_id", "event_type", "value", "k")
    return over_series(df, users(df), lambda w: [rolling_mean(F.col("value"), w, 10).alias("pred")], 9)


@query("metrics_regression", _PRED + """, q AS (SELECT * FROM p WHERE pred IS NOT NULL), m AS (SELECT avg(value) AS my FROM q)
SELECT count(*) AS n, round(avg((value - pred) * (value - pred)), 6) AS mse, round(sqrt(avg((value - pred) * (value - pred))), 6) AS rmse,
       round(avg(abs(value - pred) / greatest(2.220446049250313e-16, abs(value))), 6) AS mape,
       round(1 - sum((value - pred) * (value - pred)) / sum((value - my) * (value - my)), 6) AS r2 FROM q, m""")
def metrics_regression(spark, sf):
    got = evaluate.regression_metrics(_predicted(spark, sf), "value", "pred")
    return _r(got, ("mse", "rmse", "mape", "r2"))


@query("metrics_regression_multi", _samples_sql(10, 10) + """,
y AS (SELECT i - start - 7 AS j, value AS t, avg(value) OVER (PARTITION BY st.user_id, sample) AS p, k, st.user_id, sample
      FROM st JOIN o ON o.user_id = st.user_id AND i >= start AND i < start + 10),
z AS (SELECT j, t, p, avg(t) OVER (PARTITION BY j) AS m FROM y WHERE j >= 0),
e AS (SELECT j, avg((t - p) * (t - p)) AS mse, sqrt(avg((t - p) * (t - p))) AS rmse,
             avg(abs(t - p) / greatest(2.220446049250313e-16, abs(t))) AS mape, 1 - sum((t - p) * (t - p)) / sum((t - m) * (t - m)) AS r2
      FROM z GROUP BY j)
SELECT count(*) AS n_outputs, round(avg(mse), 6) AS mse, round(avg(rmse), 6) AS rmse, round(avg(mape), 6) AS mape, round(avg(r2), 6) AS r2 FROM e""")
def metrics_regression_multi(spark, sf):
    df, layout = _ev_series(spark, sf)
    samples = sequence.sequences(df, layout, ["value"], ["value"], 10, target_size=3)
    values = F.flatten("x")
    mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size(values)
    got = evaluate.regression_metrics_multi(samples.withColumn("p", F.array_repeat(mean, 3)), "y", "p")
    return _r(got, ("mse", "rmse", "mape", "r2"))


@query("metrics_binary", """WITH {ev}, b AS (SELECT value > 50 AS t, k > 50 AS p FROM ev),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE t = p) AS hit, count(*) FILTER (WHERE t AND p) AS tp,
             count(*) FILTER (WHERE p AND NOT t) AS fp, count(*) FILTER (WHERE t AND NOT p) AS fn FROM b)
SELECT n, round(hit / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def metrics_binary(spark, sf):
    df = ev(spark, sf).select((F.col("value") > 50).cast("int").alias("t"), (F.col("k") > 50).cast("int").alias("p"))
    return _r(evaluate.classification_metrics(df, "t", "p"), ("accuracy", "precision", "recall", "f1"))


@query("confusion_matrix", """WITH l AS (SELECT DISTINCT o_orderstatus AS c FROM orders UNION SELECT DISTINCT substr(o_orderpriority, 3, 1) FROM orders),
n AS (SELECT o_orderstatus AS t, substr(o_orderpriority, 3, 1) AS p, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT a.c AS true_class, b.c AS pred_class, coalesce(n, 0) AS n,
       round(coalesce(n / sum(n) OVER (PARTITION BY a.c), 0), 6) AS share
FROM l a CROSS JOIN l b LEFT JOIN n ON n.t = a.c AND n.p = b.c""")
def confusion_matrix(spark, sf):
    df = table(spark, sf, "orders").select("o_orderstatus", F.substring("o_orderpriority", 3, 1).alias("p"))
    return _r(evaluate.confusion_matrix(df, "o_orderstatus", "p"), ("share",))


@query("confusion_uncertainty", """SELECT o_orderstatus AS true_class, o_orderpriority AS pred_class,
round(avg(o_totalprice), 4) AS mean_uncertainty, count(*) AS n FROM orders GROUP BY 1, 2""")
def confusion_uncertainty(spark, sf):
    return _r(evaluate.confusion_uncertainty(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "o_totalprice"),
              ("mean_uncertainty",), 4)


@query("uncertainty_std", "SELECT user_id, round(avg(value), 6) AS y_pred, round(stddev_pop(value), 6) AS y_unc FROM events GROUP BY user_id")
def uncertainty_std(spark, sf):
    return _r(evaluate.draw_summary(table(spark, sf, "events"), ["user_id"], "value"), ("y_pred", "y_unc"))


_PROB = """WITH t AS (SELECT max(value) AS hi FROM events),
d AS (SELECT user_id, event_type, value / hi AS p FROM events, t),
c AS (SELECT user_id, event_type, sum(-p * ln(p + 1e-15)) AS entropy, avg(p) AS mean_prob FROM d GROUP BY 1, 2)"""


def _prob_draws(spark, sf):
    df = table(spark, sf, "events")
    hi = df.agg(F.max("value")).first()[0]
    return df.select("user_id", "event_type", (F.col("value") / F.lit(hi)).alias("p"))


@query("uncertainty_entropy", _PROB + " SELECT user_id, event_type, round(entropy, 6) + 0.0 AS entropy, round(mean_prob, 6) AS mean_prob FROM c")
def uncertainty_entropy(spark, sf):
    return _r(evaluate.draw_entropy(_prob_draws(spark, sf), ["user_id"], "event_type", "p"), ("entropy", "mean_prob"))


@query("uncertainty_entropy_sample", _PROB + " SELECT user_id, round(avg(entropy), 6) + 0.0 AS y_unc FROM c GROUP BY user_id")
def uncertainty_entropy_sample(spark, sf):
    return _r(evaluate.sample_entropy(_prob_draws(spark, sf), ["user_id"], "event_type", "p"), ("y_unc",))


@query("uncertainty_predictive_entropy", _PROB + " SELECT user_id, round(sum(-mean_prob * ln(mean_prob + 1e-15)), 6) + 0.0 AS y_unc FROM c GROUP BY user_id")
def uncertainty_predictive_entropy(spark, sf):
    return _r(evaluate.predictive_entropy(_prob_draws(spark, sf), ["user_id"], "event_type", "p"), ("y_unc",))


@query("prediction_band", """WITH d AS (SELECT user_id, avg(value) AS y_pred, stddev_pop(value) AS y_unc FROM events GROUP BY user_id)
SELECT user_id, round(y_pred, 6) AS y_pred, round(y_unc, 6) AS y_unc, round(y_pred - 1.96 * y_unc, 6) AS lower, round(y_pred + 1.96 * y_unc, 6) AS upper FROM d""")
def prediction_band(spark, sf):
    draws = evaluate.draw_summary(table(spark, sf, "events"), ["user_id"], "value")
    return _r(evaluate.prediction_band(draws, "y_pred", "y_unc"), ("y_pred", "y_unc", "lower", "upper"))


@query("prediction_frame", _samples_sql(10, 10) + """,
y AS (SELECT st.user_id, sample, i - start AS j, value, k, avg(value) OVER (PARTITION BY st.user_id, sample) AS m
      FROM st JOIN o ON o.user_id = st.user_id AND i >= start AND i < start + 10)
SELECT user_id, sample, round(value, 6) AS y_true, round(m, 6) AS pred_mean, round(value + 1, 6) AS pred_shift,
       round(CAST(k AS DOUBLE), 6) AS last_k FROM y WHERE j = 9""")
def prediction_frame(spark, sf):
    df, layout = _ev_series(spark, sf)
    samples = sequence.sequences(df, layout, ["value", "k"], ["value"], 10)
    first = F.transform("x", lambda r: r[0])
    mean = F.aggregate(first, F.lit(0.0), lambda a, v: a + v) / F.size(first)
    methods = F.array(F.struct(F.lit("mean").alias("method"), mean.alias("y_pred")),
                      F.struct(F.lit("shift").alias("method"), (F.col("y")[0] + 1).alias("y_pred")))
    predictions = samples.select("user_id", "sample", F.inline(methods))
    truth = samples.select("user_id", "sample", F.col("y")[0].alias("y_true"), "x")
    got = evaluate.prediction_frame(truth, predictions, ["user_id", "sample"], ["mean", "shift"], "x")
    got = got.select("user_id", long("sample").alias("sample"), "y_true", "pred_mean", "pred_shift",
                     F.col("last_inputs")[1].alias("last_k"))
    return _r(got, ("y_true", "pred_mean", "pred_shift", "last_k"))


@query("sequence_prediction_frame", """WITH {ev}, o AS (SELECT event_id AS i, value, count(*) OVER () AS n FROM ev),
s AS (SELECT i AS start FROM o WHERE i % 4 = 0 AND i + 4 <= n)
SELECT CAST(o.i AS BIGINT) AS step, round(value, 6) AS y_true, round(value / 2, 6) AS y_pred FROM s JOIN o ON o.i >= start AND o.i < start + 4""")
def sequence_prediction_frame(spark, sf):
    df = ev(spark, sf).select("event_id", "ts", "value")
    samples = sequence.sequences(df, one_series(df), ["value"], ["value"], 4, target_size=4, overlap=3)
    got = samples.select(long("sample").alias("i"), "y", F.transform("y", lambda v: v / 2).alias("p"))
    return _r(evaluate.sequence_prediction_frame(got, "i", "y", "p", 4), ("y_true", "y_pred"))


@query("inference_align", """WITH u AS (SELECT CAST(event_id // 10 AS BIGINT) AS a, value FROM events WHERE event_id % 10 = 0),
p AS (SELECT CAST(event_id // 10 AS BIGINT) AS sample, sum(value) AS y_pred, count(*) AS c FROM events WHERE event_id >= 0 GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM u) - (SELECT count(*) FROM p WHERE c = 10) AS gap)
SELECT p.sample, round(p.y_pred, 6) AS y_pred, round(u.value, 6) AS y_true FROM p, u, n WHERE p.c = 10 AND u.a - gap = p.sample""")
def inference_align(spark, sf):
    df = table(spark, sf, "events")
    original = df.select("event_id", F.col("value").alias("y_true"))
    predictions = (df.groupBy(F.floor(F.col("event_id") / 10).alias("sample"))
                   .agg(F.sum("value").alias("y_pred"), F.count(F.lit(1)).alias("c")).filter("c = 10").drop("c"))
    return _r(evaluate.align_with_predictions(original, predictions, "event_id", 10).select("sample", "y_pred", "y_true"),
              ("y_pred", "y_true"))


# ---------------------------------------------------------------- scores and importances of five models

_IMP = """imp0 AS (SELECT 'feature_importance_x_' || event_type AS model, 'f' || (k % 8) AS feature, sum(value) AS v FROM ev GROUP BY 1, 2),
imp AS (SELECT model, feature, v / sum(v) OVER (PARTITION BY model) AS v FROM imp0),
sc AS (SELECT 'model_' || event_type || '.h5' AS model, avg(value) / 100 AS s FROM ev GROUP BY event_type)"""
MODELS = tuple(f"feature_importance_x_{m}" for m in ("click", "error", "purchase", "signup", "view"))
FEATURES = tuple(f"f{i}" for i in range(8))


def _raw_importances(spark, sf, value="value"):
    df = ev(spark, sf)
    return df.groupBy(F.concat(F.lit("feature_importance_x_"), "event_type").alias("model"),
                      F.concat(F.lit("f"), F.col("k") % 8).alias("feature")).agg(F.sum(value).alias("importance"))


def _importances(spark, sf):
    return importance.normalise(_raw_importances(spark, sf))


def _scores(spark, sf):
    return (table(spark, sf, "events").groupBy(F.concat(F.lit("model_"), "event_type", F.lit(".h5")).alias("model"))
            .agg((F.avg("value") / 100).alias("score")))


@query("adequate_models", "WITH {ev}, " + _IMP + " SELECT model, round(s, 6) AS score FROM sc WHERE s >= 0.5")
def adequate_models(spark, sf):
    return _r(evaluate.adequate_models(_scores(spark, sf), "r2", "auto"), ("score",))


@query("method_suffix", "WITH {ev}, " + _IMP + " SELECT model, regexp_extract(model, '_([^_]*)\\.h5$', 1) AS method FROM sc")
def method_suffix_query(spark, sf):
    return _scores(spark, sf).select("model", method_suffix("model").alias("method"))


_ATTR = "WITH a AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) - {shift} AS value FROM lineitem"
    for c, shift in (("l_quantity", 25), ("l_discount", 0.05), ("l_tax", 0.04), ("l_linenumber", 4))) + ")"


def _attributions(spark, sf):
    shifts = {"l_quantity": 25.0, "l_discount": 0.05, "l_tax": 0.04, "l_linenumber": 4.0}
    cells = [F.struct(F.lit(c).alias("feature"), (F.col(c).cast("double") - s).alias("value")) for c, s in shifts.items()]
    return table(spark, sf, "lineitem").select(F.inline(F.array(*cells)))


@query("xai_importance", _ATTR + " SELECT feature, round(avg(abs(value)), 6) AS importance FROM a GROUP BY feature")
def xai_importance(spark, sf):
    return _r(importance.global_importance(_attributions(spark, sf)), ("importance",))


@query("xai_importance_norm", "WITH {ev}, " + _IMP + " SELECT model, feature, round(v, 6) AS importance FROM imp")
def xai_importance_norm(spark, sf):
    return _r(_importances(spark, sf), ("importance",))


_DIR = _ATTR + ", d AS (SELECT feature, avg(greatest(value, 0)) AS pos, avg(least(value, 0)) AS neg FROM a GROUP BY feature)"


@query("xai_directional", _DIR + " SELECT feature, round(pos, 6) + 0.0 AS positive, round(neg, 6) + 0.0 AS negative FROM d")
def xai_directional(spark, sf):
    return _r(importance.directional_importance(_attributions(spark, sf)), ("positive", "negative"))


@query("xai_top_impact", _DIR + """ SELECT feature, round(pos, 6) + 0.0 AS positive, round(neg, 6) + 0.0 AS negative,
round(abs(pos) + abs(neg), 6) AS impact FROM d ORDER BY abs(pos) + abs(neg) DESC, feature LIMIT 3""")
def xai_top_impact(spark, sf):
    got = importance.top_impact(importance.directional_importance(_attributions(spark, sf)), 3)
    return _r(got, ("positive", "negative", "impact"))


@query("xai_topn", "WITH {ev}, " + _IMP + """, r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY v DESC, feature) AS rn FROM imp)
SELECT model, feature, round(v, 6) AS importance FROM r WHERE rn <= 3""")
def xai_topn(spark, sf):
    return _r(importance.top_features(_importances(spark, sf), 3), ("importance",))


@query("xai_matrix", "WITH {ev}, " + _IMP + " SELECT model, " + ", ".join(
    f"round(max(CASE WHEN feature = '{f}' THEN v END), 6) AS {f}" for f in FEATURES) + " FROM imp GROUP BY model")
def xai_matrix(spark, sf):
    return _r(importance.importance_matrix(_importances(spark, sf), FEATURES), FEATURES)


# One model misses a value, one has NaN, and one lacks the row of a feature.
_GAP = """g AS (SELECT model, feature, CASE WHEN model LIKE '%view' AND feature = 'f3' THEN NULL ELSE v END AS v FROM imp
  UNION ALL SELECT 'nan_model', feature, CASE WHEN feature = 'f1' THEN CAST('nan' AS DOUBLE) ELSE 0.5 END FROM (SELECT DISTINCT feature FROM imp)
  UNION ALL SELECT 'short_model', feature, 0.5 FROM (SELECT DISTINCT feature FROM imp) WHERE feature <> 'f2'),
bad AS (SELECT model FROM g GROUP BY model HAVING count(DISTINCT CASE WHEN NOT isnan(v) THEN feature END) < (SELECT count(DISTINCT feature) FROM g))"""


def _with_gap(spark, sf):
    hole = F.col("model").endswith("view") & (F.col("feature") == "f3")
    rows = _importances(spark, sf).withColumn("importance", F.when(~hole, F.col("importance"))).select("model", "feature", "importance")
    features = rows.select("feature").distinct()
    nan = features.select(F.lit("nan_model").alias("model"), "feature", F.when(F.col("feature") == "f1", F.lit(float("nan"))).otherwise(0.5).alias("importance"))
    short = features.filter("feature <> 'f2'").select(F.lit("short_model").alias("model"), "feature", F.lit(0.5).alias("importance"))
    return rows.unionByName(nan).unionByName(short)


@query("combine_drop_invalid", "WITH {ev}, " + _IMP + ", " + _GAP + """
SELECT model, feature, round(v, 6) AS importance FROM g WHERE model NOT IN (SELECT model FROM bad)""")
def combine_drop_invalid(spark, sf):
    return _r(importance.drop_incomplete_models(_with_gap(spark, sf)), ("importance",))


@query("combine_mean", "WITH {ev}, " + _IMP + ", " + _GAP + """
SELECT feature, round(avg(v), 6) AS importance FROM g WHERE model NOT IN (SELECT model FROM bad) GROUP BY feature""")
def combine_mean(spark, sf):
    return _r(importance.combine_importances(_with_gap(spark, sf)), ("importance",))


_WEIGHTS = {
    "normalize": "s / sum(s) OVER ()", "softmax": "exp(s) / sum(exp(s)) OVER ()",
    "clip_negative": "greatest(s, 0) / sum(greatest(s, 0)) OVER ()", "square": "s * s / sum(s * s) OVER ()",
    "rank": "r / sum(r) OVER ()", "zscore": "(s - avg(s) OVER ()) / stddev_samp(s) OVER ()",
    "log": "ln(s + abs(lo) + 1) / sum(ln(s + abs(lo) + 1)) OVER ()", "minmax": "(s - lo) / (max(s) OVER () - lo)",
}
_WNAMES = {"clip_negative": "clip"}


def _weights_query(method, expr):
    # Scores moved by 0.495, so that some are negative.
    @query(f"weights_{_WNAMES.get(method, method)}", "WITH {ev}, " + _IMP + f""",
t AS (SELECT model, s - 0.495 AS s FROM sc),
u AS (SELECT *, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r, min(s) OVER () AS lo FROM t)
SELECT model, round({expr}, 5) + 0.0 AS weight FROM u""")
    def run(spark, sf):
        moved = _scores(spark, sf).withColumn("score", F.col("score") - F.lit(0.495))
        got = importance.model_weights(moved, method).select("model", "weight")
        return _r(got, ("weight",), 5)
    return run


for _method, _expr in _WEIGHTS.items():
    _weights_query(_method, _expr)


@query("combine_weighted", "WITH {ev}, " + _IMP + """,
w AS (SELECT regexp_extract(model, '_([^_]*)\\.h5$', 1) AS m, exp(s) / sum(exp(s)) OVER () AS w FROM sc),
c AS (SELECT feature, avg(v * w) AS x FROM imp JOIN w ON regexp_extract(imp.model, '_([^_]*)$', 1) = w.m GROUP BY feature)
SELECT feature, round(x / sum(x) OVER (), 6) AS importance FROM c""")
def combine_weighted(spark, sf):
    got = importance.combine_importances(_importances(spark, sf), _scores(spark, sf), "weighted", "softmax")
    return _r(got, ("importance",))


def _agreement_sql(ranked):
    value = ("rank() OVER (PARTITION BY model ORDER BY c) + (count(*) OVER (PARTITION BY model, c) - 1) / 2.0" if ranked else "c")
    return "WITH {ev}, " + _IMP + f""", z AS (SELECT model, feature, CASE WHEN v > 0.115 THEN v ELSE 0 END AS c FROM imp),
y AS (SELECT model, feature, {value} AS x FROM z),
m AS (SELECT a.model AS model_a, b.model AS model_b, corr(a.x, b.x) AS c FROM y a JOIN y b ON a.feature = b.feature AND a.model < b.model GROUP BY 1, 2)"""


def _agreement(spark, sf, method):
    got = _importances(spark, sf)
    return importance.agreement_matrix(got, importance.complete_models(got), method, floor=0.115)


@query("agreement_pearson", _agreement_sql(False) + " SELECT model_a, model_b, round(c, 6) + 0.0 AS correlation FROM m")
def agreement_pearson(spark, sf):
    return _r(_agreement(spark, sf, "pearson"), ("correlation",))


@query("agreement_spearman", _agreement_sql(True) + " SELECT model_a, model_b, round(c, 6) + 0.0 AS correlation FROM m")
def agreement_spearman(spark, sf):
    return _r(_agreement(spark, sf, "spearman"), ("correlation",))


@query("agreement_score", _agreement_sql(True) + " SELECT round(avg(c), 6) + 0.0 AS agreement, round(stddev_pop(c), 6) AS agreement_std FROM m")
def agreement_score(spark, sf):
    return _r(importance.agreement_score(_agreement(spark, sf, "spearman")), ("agreement", "agreement_std"))


def _adequate_names(spark, sf, keep):
    score = _scores(spark, sf).filter((F.col("score") >= 0.495) if keep else (F.col("score") < 0.495))
    return score.select(F.concat(F.lit("feature_importance_x_"), method_suffix("model")).alias("model"))


@query("models_semi", "WITH {ev}, " + _IMP + """ SELECT model, feature, round(v, 6) AS importance FROM imp
WHERE regexp_extract(model, '_([^_]*)$', 1) IN (SELECT regexp_extract(model, '_([^_]*)\\.h5$', 1) FROM sc WHERE s >= 0.495)""")
def models_semi(spark, sf):
    return _r(importance.keep_adequate(_importances(spark, sf), _adequate_names(spark, sf, True)), ("importance",))


@query("models_anti", "WITH {ev}, " + _IMP + """ SELECT model, feature, round(v, 6) AS importance FROM imp
WHERE regexp_extract(model, '_([^_]*)$', 1) NOT IN (SELECT regexp_extract(model, '_([^_]*)\\.h5$', 1) FROM sc WHERE s < 0.495)""")
def models_anti(spark, sf):
    return _r(importance.drop_inadequate(_importances(spark, sf), _adequate_names(spark, sf, False)), ("importance",))


# ---------------------------------------------------------------- emissions (events as the log)

def _log(spark, sf):
    return ev(spark, sf).select(F.col("ts").alias("timestamp"), "event_id", F.col("event_type").alias("project_name"),
                                F.col("k").cast("double").alias("duration"), F.col("value").alias("emissions"))


_LOG = "WITH {ev}, l AS (SELECT event_id, ts, event_type AS project_name, CAST(k AS DOUBLE) / 60 AS duration, value AS emissions FROM ev)"


def _minutes(spark, sf):
    return emissions.parse_log(_log(spark, sf))


@query("emissions_minutes", _LOG + " SELECT event_id, project_name, round(duration, 6) AS duration, round(emissions, 6) AS emissions FROM l")
def emissions_minutes(spark, sf):
    return _r(_minutes(spark, sf).drop("timestamp"), ("duration", "emissions"))


def _stage_query(name, agg, fn):
    @query(name, _LOG + f" SELECT project_name, round({agg}(duration), 4) AS duration, round({agg}(emissions), 4) AS emissions FROM l GROUP BY 1")
    def run(spark, sf):
        return _r(fn(_minutes(spark, sf)), ("duration", "emissions"), 4)
    return run


_stage_query("emissions_total", "sum", emissions.stage_totals)
_stage_query("emissions_mean", "avg", emissions.stage_means)
_stage_query("emissions_std", "stddev_samp", emissions.stage_deviations)


@query("emissions_full_run", _LOG + """, s AS (SELECT avg(duration) AS dm, var_samp(duration) AS dv, avg(emissions) AS em, var_samp(emissions) AS ev_ FROM l GROUP BY project_name)
SELECT round(sum(dm), 6) AS duration, round(sqrt(sum(dv)), 6) AS duration_std, round(sum(em), 6) AS emissions, round(sqrt(sum(ev_)), 6) AS emissions_std FROM s""")
def emissions_full_run(spark, sf):
    got = emissions.full_run(_minutes(spark, sf))
    return _r(got, got.columns)


@query("emissions_per_call", _LOG + " SELECT project_name, round(sum(duration) / 100, 5) AS duration, round(sum(emissions) / 100, 5) AS emissions FROM l GROUP BY 1")
def emissions_per_call(spark, sf):
    return _r(emissions.per_call(_minutes(spark, sf), 100), ("duration", "emissions"), 5)


@query("emissions_series", "SELECT event_id, round(value, 6) AS emissions FROM events ORDER BY ts, event_id")
def emissions_series(spark, sf):
    return _r(emissions.over_time(_minutes(spark, sf), ["timestamp", "event_id"]).select("event_id", "emissions"), ("emissions",))
