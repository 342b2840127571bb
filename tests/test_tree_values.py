"""Values from leaf boxes against all coalitions, and draws of one pass against fits of every resample."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesml.operators import attribution, learners, resampling, tree_values
from seriesml.operators.learners import REGRESSION

NAMES = ["a", "b", "c", "d", "e", "f"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 6)).round(1)
    y = x[:, 0] * x[:, 1] + np.where(x[:, 2] > 0, x[:, 3], -x[:, 4])
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return learners.with_vector(spark.createDataFrame(rows, ["id", *NAMES, "label"]), NAMES).cache()


@pytest.mark.parametrize("method,params", [("dt", {}), ("rf", {"n_estimators": 5}), ("gb", {"n_estimators": 4})])
def test_boxes_agree_with_all_coalitions(spark, table, method, params):
    model = learners.fit(table, method, REGRESSION, params, seed=2)
    background = attribution.Background(tuple(NAMES), tuple(tuple(r) for r in table.select(*NAMES).limit(7).collect()), (1.0, 2, 1, 3, 1, 1, 1))
    some = table.filter("id >= 120").drop("features", "label")

    def score(rows):
        return learners.predict(learners.with_vector(rows, NAMES), model).drop("features")
    want = {(r["id"], r["feature"]): r["value"] for r in attribution.shapley_values(some, ["id"], NAMES, background, score).collect()}
    got = {(r["id"], r["feature"]): r["value"] for r in tree_values.tree_shapley_values(some, ["id"], NAMES, background, model).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_boxes_hold_each_row_once(spark, table):
    model = learners.fit(table, "rf", REGRESSION, {"n_estimators": 3}, seed=5)
    boxes = tree_values.leaf_boxes(model, spark).collect()
    for r in learners.predict(table, model).limit(20).collect():
        inside = [b for b in boxes if all(lo < r["features"][f] <= hi for f, lo, hi in zip(b["feature"], b["low"], b["high"]))]
        assert len(inside) == 3 and abs(sum(b["value"] for b in inside) - r["y_pred"]) < 1e-9


def test_wide_rows_add_up(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 40))
    names = [f"x{i}" for i in range(40)]
    df = spark.createDataFrame([(i, *map(float, v), float(v[3] + v[7] * v[9])) for i, v in enumerate(x)], ["id", *names, "label"])
    data = learners.with_vector(df, names)
    model = learners.fit(data, "rf", REGRESSION, {"n_estimators": 8}, seed=1)
    background = attribution.kmeans_background(df, names, 12)
    got = tree_values.tree_shapley_values(df, ["id"], names, background, model).groupBy("id").agg(F.sum("value").alias("moved"))
    mean = attribution.background_mean(background, lambda d: learners.predict(learners.with_vector(d, names), model).drop("features"), spark)
    both = learners.predict(data, model).join(got, "id").agg(F.max(F.abs(F.col("y_pred") - mean - F.col("moved")))).first()[0]
    assert both < 1e-9


def test_models_without_boxes(spark, table):
    with pytest.raises(ValueError, match="no boxes"):
        tree_values.leaf_boxes(learners.fit(table, "linearregression", REGRESSION), spark)
    one = learners.fit(table.withColumn("label", F.lit(2.0)), "dt", REGRESSION)
    background = attribution.Background(tuple(NAMES), ((0.0,) * 6,), (1.0,))
    assert tree_values.tree_shapley_values(table.limit(3), ["id"], NAMES, background, one).agg(F.max(F.abs("value")), F.count("*")).first() == (0.0, 18)


@pytest.mark.parametrize("method,params", [("linearregression", None), ("ridgeregression", {"alpha": 5.0})])
def test_one_pass_agrees_with_refits(spark, table, method, params):
    models = learners._bootstrap(table, ["id"], method, REGRESSION, 6, params, 3, 2)
    want = {(r["id"], int(r["method"])): r["y_pred"] for r in learners.predict_many(table, {str(i): m for i, m in enumerate(models)}, ["id"]).collect()}
    got = {(r["id"], r["draw"]): r["y_pred"] for r in learners.bootstrap_draws(table, table, ["id"], method, REGRESSION, 6, params, 3).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-6


def test_draws_take_one_scan(spark, table, tmp_path):
    table.select("id", *NAMES, "label").write.parquet(f"{tmp_path}/t")
    data = learners.with_vector(spark.read.parquet(f"{tmp_path}/t"), NAMES)

    def jobs(draws):
        spark.sparkContext.setJobGroup(f"draws{draws}", "")
        resampling.bootstrap_linear(data, ["id"], draws)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"draws{draws}"))
        spark.sparkContext.setJobGroup("", "")
        return found
    assert jobs(2) == jobs(60)
    plan = resampling.bootstrap_linear(data, ["id"], 60).predict(data, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_hashes_of_all_draws_at_once(spark):
    texts = [None, "", "7", "äöü", *["x" * n for n in (48, 51, 52, 53, 54, 55, 56, 63, 64, 120, 130)], *[str(i) for i in range(95, 105)]]
    df = spark.createDataFrame([(t, i % 3 or None) for i, t in enumerate(texts)], "a string, b int").coalesce(1)
    for ids in (["a"], ["a", "b"]):
        got = df.select(resampling.id_text(ids).alias("t"), F.transform(F.sequence(F.lit(0), F.lit(104)), lambda d: resampling.times(ids, d, 11)).alias("w")).toArrow()
        assert np.array_equal(resampling.all_times(got["t"].combine_chunks(), 105, 11), np.array(got["w"].to_pylist()))


def test_draws_are_dealt_over_all_tasks(spark, table):
    n = 4 * spark.sparkContext.defaultParallelism
    got = learners.bootstrap_draws(table.coalesce(1), table.coalesce(1), ["id"], "linearregression", REGRESSION, 3)
    assert got.rdd.getNumPartitions() >= n


def test_draws_of_degenerate_tables(spark, table):
    twins = learners.with_vector(table.withColumn("b", F.col("a")).drop("features"), ["a", "b"])
    got = resampling.bootstrap_linear(twins, ["id"], 5)
    assert np.allclose(got.coefficients[:, 0], got.coefficients[:, 1])
    few = resampling.bootstrap_linear(table.limit(1), ["id"], 40)
    assert 0 < len(few.draws) < 40 and np.allclose(few.coefficients, 0)
    with pytest.raises(ValueError, match="no training rows"):
        resampling.bootstrap_linear(table.limit(0), ["id"], 5)


def test_ridge_search_agrees_with_refits(spark, table):
    from seriesml.operators import tuning
    got = {r["alpha"]: r["score"] for r in tuning.search_ridge(table, ["id"], [0.0, 2.0, 500.0], 3).collect()}
    import hashlib
    fold = {i: int(hashlib.md5(f"{i}:fold0".encode()).hexdigest()[:8], 16) % 3 for i in range(150)}
    rows = [(r["id"], np.append(r["features"].toArray(), 1.0), r["label"]) for r in table.collect()]
    for alpha, score in got.items():
        want = []
        for f in range(3):
            x, y = (np.array([r[k] for r in rows if fold[r[0]] != f]) for k in (1, 2))
            vx, vy = (np.array([r[k] for r in rows if fold[r[0]] == f]) for k in (1, 2))
            b = np.linalg.solve(x.T @ x + alpha * np.diag([1.0] * 6 + [0.0]), x.T @ y)
            want.append(1 - ((vy - vx @ b) ** 2).sum() / ((vy - vy.mean()) ** 2).sum())
        assert abs(score - np.mean(want)) < 1e-9
    assert tuning.search_ridge(table.limit(1), ["id"], [1.0], 3).first()["score"] is None
