"""Queries that train, tune, explain and apply models."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesml.functions.columns import dot, rounded
from seriesml.operators import attribution, discriminant, evaluate, learners, neighbours, resampling, tree_values, tuning
from seriesml.operators.learners import CLASSIFICATION, REGRESSION
from seriesml.plans.registry import ev, query, table
from seriesml.session import materialise

DIMS = 64


def _vectors(spark, sf):
    """embeddings as (vec_id, features, label)."""
    df = table(spark, sf, "embeddings")
    return learners.with_vector(df, "embedding").select("vec_id", "features", F.col("label").cast("double").alias("label"))


def _order_features(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_totalprice") / 1000).alias("label"))
    return learners.with_vector(df.withColumn("a", F.col("o_custkey") / 1000).withColumn("b", F.col("o_orderkey") / 1000), ["a", "b"])


def _fitted(spark, sf, method, params=None, task=CLASSIFICATION):
    data = _vectors(spark, sf)
    model = learners.fit(data, method, task, params, seed=7)
    scored = learners.predict(data, model)
    if task == CLASSIFICATION:
        return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                           rounded(F.avg((F.col("y_pred") == F.col("label")).cast("double"))).alias("accuracy"))
    return evaluate.regression_metrics(scored, "label", "y_pred")


@query("train_dt")
def train_dt(spark, sf):
    return _fitted(spark, sf, "dt")


@query("train_rf")
def train_rf(spark, sf):
    return _fitted(spark, sf, "rf")


@query("train_gbt")
def train_gbt(spark, sf):
    return _fitted(spark, sf, "gb", None, REGRESSION)


@query("train_linear_svc")
def train_linear_svc(spark, sf):
    return _fitted(spark, sf, "svm")


@query("train_mlp")
def train_mlp(spark, sf):
    return _fitted(spark, sf, "dnn")


@query("train_multi_output")
def train_multi_output(spark, sf):
    df = table(spark, sf, "embeddings")
    data = learners.with_vector(df.select("vec_id", F.slice("embedding", 1, 62).alias("x"),
                                          F.slice("embedding", 63, 2).cast("array<double>").alias("y")), "x")
    model = learners.fit_multi_output(data, "ridgeregression", "y", 2)
    return evaluate.regression_metrics_multi(model.predict(data), "y", "y_pred")


@query("train_multi_output_ols", """WITH d AS (SELECT CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) / 100 AS x,
  o_totalprice / 1000 AS a, o_custkey / 1000 AS b FROM orders),
m AS (SELECT var_pop(a) * (1 - regr_r2(a, x)) AS ma, regr_r2(a, x) AS ra, var_pop(b) * (1 - regr_r2(b, x)) AS mb, regr_r2(b, x) AS rb FROM d)
SELECT CAST(2 AS BIGINT) AS n_outputs, round((ma + mb) / 2, 4) AS mse, round((sqrt(ma) + sqrt(mb)) / 2, 6) AS rmse, round((ra + rb) / 2, 6) AS r2 FROM m""")
def train_multi_output_ols(spark, sf):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double")
    df = table(spark, sf, "orders").select((days / 100).alias("x"), F.array(F.col("o_totalprice") / 1000, F.col("o_custkey") / 1000).alias("y"))
    data = learners.with_vector(df, "x")
    model = learners.fit_multi_output(data, "linearregression", "y", 2)
    got = evaluate.regression_metrics_multi(model.predict(data), "y", "y_pred")
    return got.select("n_outputs", rounded("mse", 4).alias("mse"), rounded("rmse").alias("rmse"), rounded("r2").alias("r2"))


def _slope_table(spark, sf, method, params=None):
    data = _order_features(spark, sf)
    coef, intercept = learners.linear_coefficients(learners.fit(data, method, REGRESSION, params))
    n = F.count(F.lit(1))
    cells = F.array(*[F.lit(float(c)) for c in [*coef, intercept]])
    return data.agg(n.alias("n")).select("n", F.posexplode(cells).alias("term", "value")).withColumn("value", rounded("value"))


_TWO = """WITH d AS (SELECT o_custkey / 1000 AS a, o_orderkey / 1000 AS b, o_totalprice / 1000 AS y FROM orders),
c AS (SELECT count(*) AS n, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb,
             avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM d),
s AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM c)
SELECT n, CAST(0 AS INTEGER) AS term, round(wa, 6) + 0.0 AS value FROM s UNION ALL SELECT n, 1, round(wb, 6) + 0.0 FROM s
UNION ALL SELECT n, 2, round(my - wa * ma - wb * mb, 6) FROM s"""


@query("train_ols", _TWO)
def train_ols(spark, sf):
    return _slope_table(spark, sf, "linearregression")


def _signs(l1, l2):
    """Two-feature elastic net: of all sign patterns that agree with their own solution the one with the smallest loss."""
    return f"""WITH d AS (SELECT o_custkey / 1000 AS a, o_orderkey / 1000 AS b, o_totalprice / 1000 AS y FROM orders),
c AS (SELECT count(*) AS n, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb,
             avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM d),
p AS (SELECT * FROM c, (VALUES (-1), (0), (1)) s(sa), (VALUES (-1), (0), (1)) t(sb)),
q AS (SELECT *, CASE WHEN sa = 0 THEN 0 WHEN sb = 0 THEN (ay - {l1} * sa) / (aa + {l2})
    ELSE ((ay - {l1} * sa) * (bb + {l2}) - (yb - {l1} * sb) * ab) / ((aa + {l2}) * (bb + {l2}) - ab * ab) END AS wa,
  CASE WHEN sb = 0 THEN 0 WHEN sa = 0 THEN (yb - {l1} * sb) / (bb + {l2})
    ELSE ((yb - {l1} * sb) * (aa + {l2}) - (ay - {l1} * sa) * ab) / ((aa + {l2}) * (bb + {l2}) - ab * ab) END AS wb FROM p),
r AS (SELECT *, (aa * wa * wa + 2 * ab * wa * wb + bb * wb * wb) / 2 - ay * wa - yb * wb + {l1} * (abs(wa) + abs(wb)) + {l2} / 2.0 * (wa * wa + wb * wb) AS loss
  FROM q WHERE sign(wa) = sa AND sign(wb) = sb),
s AS (SELECT * FROM r ORDER BY loss LIMIT 1)
SELECT n, CAST(0 AS INTEGER) AS term, round(wa, 6) + 0.0 AS value FROM s UNION ALL SELECT n, 1, round(wb, 6) + 0.0 FROM s
UNION ALL SELECT n, 2, round(my - wa * ma - wb * mb, 6) FROM s"""


@query("train_lasso", _signs(1.0, 0.0))
def train_lasso(spark, sf):
    return _slope_table(spark, sf, "lasso")


@query("train_elasticnet", _signs(0.5, 0.5))
def train_elasticnet(spark, sf):
    return _slope_table(spark, sf, "elasticnet")


_DAYS = "CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)"


def _one_feature(spark, sf):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double")
    df = table(spark, sf, "orders").select((days / 100).alias("x"), (F.col("o_totalprice") / 1000).alias("label"))
    return learners.with_vector(df, "x"), df


@query("train_ols_simple", f"""WITH d AS (SELECT {_DAYS} / 100 AS x, o_totalprice / 1000 AS y FROM orders)
SELECT round(regr_slope(y, x), 5) AS slope, round(regr_intercept(y, x), 5) AS intercept FROM d""")
def train_ols_simple(spark, sf):
    return _simple(spark, sf, "linearregression")


@query("train_ridge_simple", f"""WITH d AS (SELECT {_DAYS} / 100 AS x, o_totalprice / 1000 AS y FROM orders),
s AS (SELECT covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + 5000.0) AS b, avg(x) AS mx, avg(y) AS my FROM d)
SELECT round(b, 5) AS slope, round(my - b * mx, 5) AS intercept FROM s""")
def train_ridge_simple(spark, sf):
    return _simple(spark, sf, "ridgeregression", {"alpha": 5000.0})


_SOFT = f"""WITH d AS (SELECT {_DAYS} / 100 AS x, o_totalprice / 1000 AS y FROM orders),
s AS (SELECT sign(covar_pop(x, y)) * greatest(abs(covar_pop(x, y)) - {{l1}}, 0) / (var_pop(x) + {{l2}}) AS b, avg(x) AS mx, avg(y) AS my FROM d)
SELECT round(b, 5) + 0.0 AS slope, round(my - b * mx, 5) AS intercept FROM s"""


@query("train_sgd_simple", f"""WITH d AS (SELECT {_DAYS} / 100 AS x, o_totalprice / 1000 AS y FROM orders),
s AS (SELECT covar_pop(x, y) / (var_pop(x) + 1e-4) AS b, avg(x) AS mx, avg(y) AS my FROM d)
SELECT round(b, 5) AS slope, round(my - b * mx, 5) AS intercept FROM s""")
def train_sgd_simple(spark, sf):
    return _simple(spark, sf, "sgd")


@query("train_multi_output_ridge", f"""WITH d AS (SELECT {_DAYS} / 100 AS x, o_totalprice / 1000 AS a, o_custkey / 1000 AS b FROM orders),
s AS (SELECT avg(x) AS mx, avg(a) AS ma, avg(b) AS mb, covar_pop(x, a) * count(*) / (var_pop(x) * count(*) + 1.0) AS wa,
             covar_pop(x, b) * count(*) / (var_pop(x) * count(*) + 1.0) AS wb FROM d)
SELECT o_orderkey, round(ma + wa * ({_DAYS} / 100 - mx), 4) AS a, round(mb + wb * ({_DAYS} / 100 - mx), 4) AS b FROM orders, s""")
def train_multi_output_ridge(spark, sf):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double")
    df = table(spark, sf, "orders").select("o_orderkey", (days / 100).alias("x"), F.array(F.col("o_totalprice") / 1000, F.col("o_custkey") / 1000).alias("y"))
    data = learners.with_vector(df, "x")
    got = learners.fit_multi_output(data, "ridgeregression", "y", 2).predict(data, "p")
    return got.select("o_orderkey", rounded(F.col("p")[0], 4).alias("a"), rounded(F.col("p")[1], 4).alias("b"))


# One split of the month (12 values, all thresholds of which fit into the bins) for the price.
_MONTH = "CAST(month(CAST(o_orderdate AS DATE)) AS DOUBLE)"


def _split_sql(rows, value, name):
    """The threshold of x with the largest sum of squares between the two sides, and the means of both."""
    return f"""{name}t AS (SELECT t.x AS cut, sum(CASE WHEN r.x <= t.x THEN 1 ELSE 0 END) AS n1, sum(CASE WHEN r.x <= t.x THEN {value} ELSE 0 END) AS s1,
  count(*) AS n, sum({value}) AS s FROM (SELECT DISTINCT x FROM {rows}) t CROSS JOIN {rows} r GROUP BY t.x),
{name} AS (SELECT cut, s1 / n1 AS low, (s - s1) / (n - n1) AS high FROM {name}t WHERE n1 < n ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) DESC LIMIT 1)"""


_STUMP = f"WITH d AS (SELECT o_orderkey, {_MONTH} AS x, o_totalprice / 1000 AS y FROM orders), " + _split_sql("d", "y", "u")


def _months(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.month(F.col("o_orderdate").cast("date")).cast("double").alias("x"), (F.col("o_totalprice") / 1000).alias("label"))
    return learners.with_vector(df, ["x"])


def _stump(spark, sf, method, params):
    data = _months(spark, sf)
    got = learners.predict(data, learners.fit(data, method, REGRESSION, params, seed=3))
    return got.select("o_orderkey", rounded("y_pred", 4).alias("y_pred"))


_ONE_SPLIT = _STUMP + " SELECT o_orderkey, round(CASE WHEN x <= cut THEN low ELSE high END, 4) AS y_pred FROM d, u"


@query("train_dt_split", _ONE_SPLIT)
def train_dt_split(spark, sf):
    return _stump(spark, sf, "dt", {"max_depth": 1})


@query("train_rf_split", _ONE_SPLIT)
def train_rf_split(spark, sf):
    """Without resampling and with all features, every tree of a forest is the tree."""
    return _stump(spark, sf, "rf", {"max_depth": 1, "bootstrap": False})


@query("train_gbt_rounds", _STUMP + """, e AS (SELECT *, CASE WHEN x <= cut THEN low ELSE high END AS p FROM d, u), f AS (SELECT o_orderkey, x, p, 2 * (y - p) AS z FROM e), """
       + _split_sql("f", "z", "w") + """
SELECT o_orderkey, round(p + 0.1 * CASE WHEN x <= w.cut THEN w.low ELSE w.high END, 4) AS y_pred FROM f, w""")
def train_gbt_rounds(spark, sf):
    """The second round fits what the first left over."""
    return _stump(spark, sf, "gb", {"n_estimators": 2, "max_depth": 1})


# A label that one wide gap separates: every learner has to get each row right.
_APART = """SELECT CAST(o_orderkey % 2 AS DOUBLE) AS label, count(*) AS n, CAST(1 AS DOUBLE) AS accuracy FROM orders GROUP BY 1"""


def _apart(spark, sf):
    label = (F.col("o_orderkey") % 2).cast("double")
    df = table(spark, sf, "orders").select("o_orderkey", label.alias("label"), (label * 10 - 5 + F.pmod("o_custkey", F.lit(7)) / 10).alias("a"),
                                           (F.pmod("o_custkey", F.lit(5)) / 10).alias("b"))
    return learners.with_vector(df, ["a", "b"])


def _right(scored, *by):
    return scored.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg((F.col("y_pred") == F.col("label")).cast("double"))).alias("accuracy"))


@query("train_svc_apart", _APART)
def train_svc_apart(spark, sf):
    data = _apart(spark, sf)
    return _right(learners.predict(data, learners.fit(data, "svm", CLASSIFICATION, seed=1)))


@query("train_mlp_apart", _APART)
def train_mlp_apart(spark, sf):
    data = _apart(spark, sf)
    return _right(learners.predict(data, learners.fit(data, "dnn", CLASSIFICATION, seed=1)))


@query("train_lda_apart", _APART)
def train_lda_apart(spark, sf):
    data = _apart(spark, sf).withColumn("x", F.array("a", "b"))
    return _right(discriminant.fit_lda(data, "x", "label").predict(data, "x"))


@query("train_ensemble_apart", "SELECT * FROM (" + _APART + """), (VALUES ('dt'), ('rf'), ('gb'), ('xgb'), ('sgd'), ('lgbm')) m(method)""")
def train_ensemble_apart(spark, sf):
    data = _apart(spark, sf)
    models = learners.fit_ensemble(data, CLASSIFICATION, seed=3)
    return _right(learners.predict_many(data, models, ["o_orderkey", "label"]), "method")


@query("tree_importances_apart", "SELECT 'a' AS feature, CAST(1 AS DOUBLE) AS importance UNION ALL SELECT 'b', 0")
def tree_importances_apart(spark, sf):
    """Only one feature tells the label, so it has all the importance."""
    model = learners.fit(_apart(spark, sf), "dt", CLASSIFICATION, seed=1)
    return learners.tree_importances(model, ["a", "b"], spark)


@query("train_lasso_simple", _SOFT.format(l1=0.05, l2=0.0))
def train_lasso_simple(spark, sf):
    return _simple(spark, sf, "lasso", {"alpha": 0.05})


@query("train_elasticnet_simple", _SOFT.format(l1=0.03, l2=0.03))
def train_elasticnet_simple(spark, sf):
    return _simple(spark, sf, "elasticnet", {"alpha": 0.06})


def _simple(spark, sf, method, params=None):
    data, _ = _one_feature(spark, sf)
    coef, intercept = learners.linear_coefficients(learners.fit(data, method, REGRESSION, params))
    return spark.createDataFrame([(coef[0], intercept)], "slope double, intercept double").select(
        rounded("slope", 5).alias("slope"), rounded("intercept", 5).alias("intercept"))


def _texts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.array((F.col("n_chars") / 1000)).alias("x"))
    return docs.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")


_LEN = """WITH d AS (SELECT n_chars / 1000 AS x, quality AS c FROM documents JOIN labels USING (doc_id)),
s AS (SELECT c, count(*) AS n, avg(x) AS m, var_samp(x) AS v, sum(x * x) - sum(x) * sum(x) / count(*) AS w, (SELECT count(*) FROM d) AS total,
             (SELECT count(DISTINCT c) FROM d) AS k FROM d GROUP BY c)"""


@query("train_lda_1d", _LEN + """, p AS (SELECT sum(w) / (any_value(total) - any_value(k)) AS v FROM s)
SELECT CAST(c AS DOUBLE) AS class, round(m / p.v, 6) AS coef, round(-m * m / (2 * p.v) + ln(n / total), 6) AS intercept FROM s, p""")
def train_lda_1d(spark, sf):
    fitted = discriminant.fit_lda(_texts(spark, sf), "x", "label")
    rows = [(c, float(w[0]), float(b)) for c, w, b in zip(fitted.classes, fitted.coef, fitted.intercept)]
    return spark.createDataFrame(rows, "class double, coef double, intercept double").select(
        "class", rounded("coef").alias("coef"), rounded("intercept").alias("intercept"))


@query("train_qda_1d", _LEN + """, q AS (SELECT doc_id, x, c, ln(n / total) - 0.5 * ln(v) - 0.5 * (x - m) * (x - m) / v AS score
  FROM (SELECT doc_id, n_chars / 1000 AS x FROM documents JOIN labels USING (doc_id)), s)
SELECT doc_id, CAST(max_by(c, score) AS DOUBLE) AS y_pred FROM q GROUP BY doc_id""")
def train_qda_1d(spark, sf):
    df = _texts(spark, sf)
    return discriminant.fit_qda(df, "x", "label").predict(df, "x").select("doc_id", "y_pred")


@query("predict_lda_1d", _LEN + """, p AS (SELECT sum(w) / (any_value(total) - any_value(k)) AS v FROM s),
q AS (SELECT doc_id, c, x * m / p.v - m * m / (2 * p.v) + ln(n / total) AS score
  FROM (SELECT doc_id, n_chars / 1000 AS x FROM documents JOIN labels USING (doc_id)), s, p)
SELECT doc_id, CAST(max_by(c, score) AS DOUBLE) AS y_pred FROM q GROUP BY doc_id""")
def predict_lda_1d(spark, sf):
    df = _texts(spark, sf)
    return discriminant.fit_lda(df, "x", "label").predict(df, "x").select("doc_id", "y_pred")


@query("train_lda")
def train_lda(spark, sf):
    df = table(spark, sf, "embeddings").withColumn("x", F.col("embedding").cast("array<double>"))
    scored = discriminant.fit_lda(df, "x", "label").predict(df, "x")
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                       rounded(F.avg((F.col("y_pred") == F.col("label")).cast("double"))).alias("accuracy"))


_KNN = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT a.vec_id, b.label, list_distance(a.v, b.v) AS d,
             row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rk
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
k AS (SELECT * FROM n WHERE rk <= 5)"""


def _near(spark, sf):
    return neighbours.leave_one_out(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")


@query("knn_neighbours", _KNN + " SELECT vec_id, CAST(rk AS INTEGER) AS rank, label, round(d, 6) AS distance FROM k")
def knn_neighbours(spark, sf):
    return _near(spark, sf).select("vec_id", "rank", "label", rounded("distance").alias("distance"))


@query("knn_classify", _KNN + """, c AS (SELECT vec_id, label, count(*) AS n FROM k GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) AS o FROM c) SELECT vec_id, label AS y_pred FROM r WHERE o = 1""")
def knn_classify(spark, sf):
    return neighbours.classify(_near(spark, sf), "vec_id")


@query("knn_regress", _KNN + """, h AS (SELECT *, min(d) OVER (PARTITION BY vec_id) = 0 AS hit FROM k),
w AS (SELECT *, CASE WHEN hit THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END ELSE 1 / d END AS w FROM h)
SELECT vec_id, round(sum(w * label) / sum(w), 6) AS y_pred FROM w GROUP BY vec_id""")
def knn_regress(spark, sf):
    return neighbours.regress(_near(spark, sf), "vec_id", "distance").withColumn("y_pred", rounded("y_pred"))


@query("knn_approx", """SELECT count(*) AS n_queries, 5 * count(*) AS n_wanted, true AS found_nine_tenths FROM embeddings WHERE vec_id % 20 = 0""")
def knn_approx(spark, sf):
    """Neighbours by hash tables of every twentieth vector among all, measured against the exact ones."""
    df = table(spark, sf, "embeddings")
    asked = df.filter("vec_id % 20 = 0")
    found = neighbours.approximate_neighbours(neighbours.fit_hash_tables(df, "vec_id", "embedding", "label"), asked, "vec_id", "embedding")
    exact = neighbours.neighbours(neighbours.fit_neighbours(df, "vec_id", "embedding", "label"), asked, "vec_id", "embedding")
    share = neighbours.recall(found, materialise(exact, "exact"), "vec_id")
    return share.select((F.col("n_wanted") / 5).cast("long").alias("n_queries"), "n_wanted", (F.col("recall") >= 0.9).alias("found_nine_tenths"))


@query("train_ensemble")
def train_ensemble(spark, sf):
    data = _order_features(spark, sf)
    small = {"dt": {"max_depth": 4}, "rf": {"n_estimators": 10, "max_depth": 4}, "gb": {"n_estimators": 5},
             "xgb": {"n_estimators": 5}, "lgbm": {"n_estimators": 5}}
    models = learners.fit_ensemble(data, REGRESSION, small, seed=3)
    scored = learners.predict_many(data, models, ["o_orderkey", "label"])
    return evaluate.regression_metrics(scored, "label", "y_pred", ["method"])


@query("tune_random_search")
def tune_random_search(spark, sf):
    data = _order_features(spark, sf)
    grid = {"max_depth": (2, 4), "n_estimators": (5, 10), "min_samples_split": (2, 4, 6), "min_samples_leaf": (1, 3, 5)}
    return tuning.random_search(data, "rf", REGRESSION, grid, tries=4, folds=3, seed=5)[1]


@query("tune_neighbours")
def tune_neighbours(spark, sf):
    return tuning.search_neighbours(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", CLASSIFICATION)


PENALTIES = (0.01, 0.1, 1.0, 10.0, 100.0, 1e3, 1e4, 1e5, 1e6, 1e7)


@query("tune_ridge", f"""WITH d AS (SELECT o_orderkey, {_DAYS} / 100 AS x, o_totalprice / 1000 AS y, CAST(('0x' || md5(o_orderkey || ':fold3')[1:8]) AS BIGINT) % 5 AS fold FROM orders),
f AS (SELECT DISTINCT fold FROM d), a AS (SELECT unnest([{', '.join(map(str, PENALTIES))}]::DOUBLE[]) AS alpha),
t AS (SELECT f.fold, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) * count(*) AS xx, covar_pop(x, y) * count(*) AS xy FROM f JOIN d ON d.fold <> f.fold GROUP BY f.fold),
m AS (SELECT alpha, fold, xy / (xx + alpha) AS b, my - xy / (xx + alpha) * mx AS c FROM t, a),
s AS (SELECT alpha, m.fold, 1 - sum((y - c - b * x) ** 2) / (var_pop(y) * count(*)) AS r2 FROM m JOIN d USING (fold) GROUP BY alpha, m.fold)
SELECT alpha, round(avg(r2), 6) + 0.0 AS score FROM s GROUP BY alpha""")
def tune_ridge(spark, sf):
    """Ten penalties over five hashed folds from one pass."""
    df = table(spark, sf, "orders")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double")
    data = learners.with_vector(df.select("o_orderkey", (days / 100).alias("x"), (F.col("o_totalprice") / 1000).alias("label")), "x")
    return tuning.search_ridge(data, ["o_orderkey"], PENALTIES, folds=5, seed=3).select("alpha", rounded("score").alias("score"))


@query("tree_importances")
def tree_importances(spark, sf):
    model = learners.fit(_vectors(spark, sf), "rf", CLASSIFICATION, seed=1)
    return learners.tree_importances(model, [f"e{i}" for i in range(DIMS)], spark)


@query("bootstrap_draws")
def bootstrap_draws(spark, sf):
    data = _order_features(spark, sf)
    draws = learners.bootstrap_draws(data, data, ["o_orderkey"], "linearregression", REGRESSION, 100, seed=11)
    return evaluate.draw_summary(draws, ["o_orderkey"], "y_pred")


@query("bootstrap_ols", f"""WITH d AS (SELECT o_orderkey, {_DAYS} / 100 AS x, o_totalprice / 1000 AS y FROM orders),
u AS (SELECT d.*, draw, CAST(('0x' || md5(o_orderkey || ':' || draw || ':11')[1:8]) AS BIGINT) / 4294967296.0 AS u FROM d, range(0, 100) r(draw)),
w AS (SELECT *, {' + '.join(f'CAST(u >= {p} AS INTEGER)' for p in resampling.POISSON_ONE)} AS w FROM u),
m AS (SELECT draw, sum(w) AS n, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my, sum(w * x * x) AS xx, sum(w * x * y) AS xy FROM w GROUP BY draw),
c AS (SELECT draw, (xy / n - mx * my) / (xx / n - mx * mx) AS b, mx, my FROM m)
SELECT o_orderkey, round(avg(my + b * (x - mx)), 4) AS mean, round(stddev_pop(my + b * (x - mx)), 4) AS std FROM d, c GROUP BY o_orderkey""")
def bootstrap_ols(spark, sf):
    """A hundred resamples by hashes of the row ids."""
    data = _one_feature(spark, sf)[0]
    df = table(spark, sf, "orders")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double")
    data = learners.with_vector(df.select("o_orderkey", (days / 100).alias("x"), (F.col("o_totalprice") / 1000).alias("label")), "x")
    draws = learners.bootstrap_draws(data, data, ["o_orderkey"], "linearregression", REGRESSION, 100, seed=11)
    return draws.groupBy("o_orderkey").agg(rounded(F.avg("y_pred"), 4).alias("mean"), rounded(F.stddev_pop("y_pred"), 4).alias("std"))


# ---------------------------------------------------------------- attributions

WEIGHTS = {"value": 0.5, "k": -2.0}


def _linear_score(df):
    return df.withColumn("y_pred", dot(WEIGHTS, 3.0))


@query("xai_background")
def xai_background(spark, sf):
    df = table(spark, sf, "embeddings").select(*[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(DIMS)])
    background = attribution.kmeans_background(df, df.columns, seed=2)
    return spark.createDataFrame([(*p, w) for p, w in zip(background.points, background.weights)], [*df.columns, "n_rows"])


@query("xai_shapley_linear", """WITH {ev}, m AS (SELECT avg(value) AS mv, avg(k) AS mk FROM ev)
SELECT event_id, 'value' AS feature, round(0.5 * (value - mv), 4) + 0.0 AS value FROM ev, m
UNION ALL SELECT event_id, 'k', round(-2.0 * (k - mk), 4) + 0.0 FROM ev, m""")
def xai_shapley_linear(spark, sf):
    df = ev(spark, sf)
    groups = df.groupBy("event_type").agg(F.avg("value").alias("value"), F.avg("k").alias("k"), F.count(F.lit(1)).alias("n"))
    background = attribution.sampled_background(groups, ["value", "k"], "n")
    got = attribution.shapley_values(df, ["event_id"], ["value", "k"], background, _linear_score)
    return got.withColumn("value", rounded("value", 4))


@query("xai_background_groups", """SELECT round(avg((o_orderkey % 2) * 10 - 5 + (o_custkey % 7) / 10), 6) AS a, round(avg((o_custkey % 5) / 10), 6) AS b, CAST(count(*) AS DOUBLE) AS n_rows
FROM orders GROUP BY o_orderkey % 2""")
def xai_background_groups(spark, sf):
    """Two groups far apart: the centres are their means and the weights their sizes."""
    background = attribution.kmeans_background(_apart(spark, sf), ["a", "b"], 2, seed=2)
    rows = spark.createDataFrame([(*p, w) for p, w in zip(background.points, background.weights)], "a double, b double, n_rows double")
    return rows.select(rounded("a").alias("a"), rounded("b").alias("b"), "n_rows")


@query("xai_shapley_split", """WITH d AS (SELECT o_orderkey, o_orderkey % 2 AS label FROM orders), m AS (SELECT avg(label) AS m FROM d)
SELECT o_orderkey, 'a' AS feature, round(label - m, 6) + 0.0 AS value FROM d, m UNION ALL SELECT o_orderkey, 'b', CAST(0 AS DOUBLE) FROM d""")
def xai_shapley_split(spark, sf):
    """A tree that needs one feature: it moves the prediction from the mean of the background by itself."""
    data = _apart(spark, sf)
    model = learners.fit(data, "dt", REGRESSION, seed=1)

    def score(rows):
        return learners.predict(learners.with_vector(rows, ["a", "b"]), model).drop("features")
    background = attribution.kmeans_background(data, ["a", "b"], 2, seed=2)
    got = attribution.shapley_values(data, ["o_orderkey"], ["a", "b"], background, score)
    return got.withColumn("value", rounded("value"))


@query("xai_shapley_tree")
def xai_shapley_tree(spark, sf):
    """All values of the vectors, a forest of the default size, fifty centres; nothing sampled."""
    names = [f"e{i}" for i in range(DIMS)]
    df = table(spark, sf, "embeddings").select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    data = learners.with_vector(df, names).withColumn("label", F.col("label").cast("double"))
    model = learners.fit(data, "rf", REGRESSION, seed=4)
    background = attribution.kmeans_background(df, names, seed=4)
    return tree_values.tree_shapley_values(df, ["vec_id"], names, background, model)


_TWO_DEEP = "CASE WHEN o_orderkey % 2 = 1 THEN 4.0 + 2.0 * (o_custkey % 2) ELSE 0.0 END"


@query("xai_shapley_two_deep", """WITH d AS (SELECT o_orderkey, o_orderkey % 2 AS a, o_custkey % 2 AS b FROM orders),
g AS (SELECT a, b, count(*) * 1.0 / (SELECT count(*) FROM d) AS w FROM d GROUP BY a, b),
v AS (SELECT o_orderkey, sum(w * ((d.a - g.a) * (4 + 2 * g.b) + (d.a - g.a) * (4 + 2 * d.b)) / 2) AS a,
  sum(w * (g.a * 2 * (d.b - g.b) + d.a * 2 * (d.b - g.b)) / 2) AS b FROM d, g GROUP BY o_orderkey)
SELECT o_orderkey, 'a' AS feature, round(CAST(a AS DOUBLE), 6) + 0.0 AS value FROM v UNION ALL SELECT o_orderkey, 'b', round(CAST(b AS DOUBLE), 6) + 0.0 FROM v""")
def xai_shapley_two_deep(spark, sf):
    """A tree of depth two whose splits are known: the second feature counts only where the first one is 1."""
    df = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 2).cast("double").alias("a"), (F.col("o_custkey") % 2).cast("double").alias("b"),
                                           F.expr(_TWO_DEEP).cast("double").alias("label"))
    model = learners.fit(learners.with_vector(df, ["a", "b"]), "dt", REGRESSION, seed=1)
    groups = df.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    got = tree_values.tree_shapley_values(df, ["o_orderkey"], ["a", "b"], attribution.sampled_background(groups, ["a", "b"], "n", 4), model)
    return got.withColumn("value", rounded("value"))


@query("xai_lime")
def xai_lime(spark, sf):
    df = ev(spark, sf).groupBy("user_id").agg(F.avg("value").alias("value"), F.avg("k").alias("k"))
    got = attribution.local_surrogate(df, ["user_id"], ["value", "k"], df, _linear_score)
    return got.withColumn("value", rounded("value"))
