import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesml.functions.columns import dot
from seriesml.operators import attribution, discriminant, evaluate, learners, neighbours
from seriesml.operators.learners import CLASSIFICATION, REGRESSION


@pytest.fixture(scope="module")
def planted(spark):
    """A linear target, a step class of three values, and noise."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.2 * rng.normal(size=600) + 5
    c = (x[:, 0] > 0.4).astype(int) + (x[:, 0] > -0.4)
    pdf = pd.DataFrame({"id": range(600), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y, "cls": c.astype(float)})
    return learners.with_vector(spark.createDataFrame(pdf), ["a", "b", "c"]).cache()


@pytest.mark.parametrize("method,params", [
    ("dt", {}), ("rf", {"n_estimators": 20}), ("gb", {"n_estimators": 40}), ("linearregression", {}), ("sgd", {}),
    ("ridgeregression", {}), ("lasso", {"alpha": 0.01}), ("elasticnet", {"alpha": 0.01})])
def test_regression_floor(planted, method, params):
    data = planted.withColumn("label", F.col("y"))
    model = learners.fit(data.filter("id < 450"), method, REGRESSION, params, seed=1)
    got = evaluate.regression_metrics(learners.predict(data.filter("id >= 450"), model), "label", "y_pred").first()
    assert got["r2"] > 0.8


@pytest.mark.parametrize("method,params,floor", [
    ("dt", {}, 0.9), ("rf", {"n_estimators": 20}, 0.9), ("gb", {"n_estimators": 5}, 0.9), ("dnn", {"n_neurons": [8]}, 0.9),
    ("svm", {"max_iter": 20}, 0.55), ("sgd", {"max_iter": 20}, 0.55)])
def test_classification_floor(planted, method, params, floor):
    data = planted.withColumn("label", F.col("cls"))
    model = learners.fit(data.filter("id < 450"), method, CLASSIFICATION, params, seed=1)
    scored = learners.predict(data.filter("id >= 450"), model)
    assert scored.agg(F.avg((F.col("y_pred") == F.col("label")).cast("double"))).first()[0] > floor


def test_penalised_coefficients_match_direct_solutions(planted):
    pdf = planted.select("a", "b", "c", "y").toPandas()
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["y"].to_numpy()
    data = planted.withColumn("label", F.col("y"))
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    alpha, l1 = 0.3, 0.5
    ridge = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(3), xc.T @ yc)
    got, _ = learners.linear_coefficients(learners.fit(data, "ridgeregression", REGRESSION, {"alpha": 7.0}))
    assert np.allclose(got, ridge, atol=1e-9)
    for method, ratio, params in (("lasso", 1.0, {"alpha": alpha}), ("elasticnet", l1, {"alpha": alpha, "l1_ratio": l1})):
        w = np.zeros(3)
        for _ in range(2000):
            for j in range(3):
                r = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / n
                w[j] = np.sign(r) * max(abs(r) - alpha * ratio, 0) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - ratio))
        got, _ = learners.linear_coefficients(learners.fit(data, method, REGRESSION, params))
        assert np.allclose(got, w, atol=1e-5), method


def test_discriminants(spark, planted):
    df = planted.select("id", F.array("a", "b", "c").alias("x"), F.col("cls").alias("label"))
    pdf = df.toPandas()
    x, c = np.stack(pdf["x"]), pdf["label"].to_numpy()
    lda, qda = discriminant.fit_lda(df, "x", "label"), discriminant.fit_qda(df, "x", "label")
    cov = sum(np.cov(x[c == k].T) * ((c == k).sum() - 1) for k in range(3)) / (len(c) - 3)
    inv = np.linalg.inv(cov)
    want = np.stack([x @ inv @ x[c == k].mean(0) - 0.5 * x[c == k].mean(0) @ inv @ x[c == k].mean(0) + np.log((c == k).mean())
                     for k in range(3)], 1).argmax(1)
    assert [r["y_pred"] for r in lda.predict(df, "x").orderBy("id").collect()] == want.tolist()
    scores = []
    for k in range(3):
        s, m = np.cov(x[c == k].T), x[c == k].mean(0)
        d = x - m
        scores.append(np.log((c == k).mean()) - 0.5 * np.log(np.linalg.det(s)) - 0.5 * ((d @ np.linalg.inv(s)) * d).sum(1))
    want = np.stack(scores, 1).argmax(1)
    assert [r["y_pred"] for r in qda.predict(df, "x").orderBy("id").collect()] == want.tolist()


@pytest.mark.parametrize("pivots,block", [(1, 50), (12, 40), (30, 10_000)])
def test_neighbours_by_brute_force(spark, pivots, block):
    """Clustered points, a third of them one and the same point."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(100, 3)) + rng.integers(0, 4, (100, 1)) * 6, np.zeros((60, 3)), rng.normal(size=(20, 3))])
    train = spark.createDataFrame([(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)], "id bigint, x array<double>, label int")
    q = rng.normal(size=(50, 3)) * 5
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id bigint, x array<double>")
    model = neighbours.fit_neighbours(train, "id", "x", "label", 7, pivots, block)
    got = neighbours.neighbours(model, asked, "id", "x").orderBy("id", "rank").collect()
    d = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(2))
    want = [(i, r + 1, j) for i in range(50) for r, j in enumerate(sorted(range(len(x)), key=lambda j: (d[i, j], j))[:7])]
    assert [(r["id"], r["rank"], r["neighbour"]) for r in got] == want


def test_neighbour_votes(spark):
    rows = [(1, 1, 2, 0.0), (1, 2, 1, 1.0), (1, 3, 1, 1.0), (2, 1, 1, 1.0), (2, 2, 0, 1.0)]
    found = spark.createDataFrame(rows, "id int, rank int, label int, distance double")
    assert {tuple(r) for r in neighbours.classify(found, "id").collect()} == {(1, 1), (2, 0)}
    assert {tuple(r) for r in neighbours.classify(found, "id", "distance").collect()} == {(1, 2), (2, 0)}
    assert dict(neighbours.regress(found, "id", "distance").collect()) == {1: 2.0, 2: 0.5}


def _tree(planted):
    data = planted.withColumn("label", F.col("y"))
    model = learners.fit(data, "dt", REGRESSION, {"max_depth": 5}, seed=2)

    def score(rows):
        return learners.predict(learners.with_vector(rows, ["a", "b", "c"]), model).drop("features")
    return score


@pytest.mark.parametrize("exact", [True, False])
def test_shapley_values_add_up(spark, planted, exact):
    score = _tree(planted)
    background = attribution.kmeans_background(planted, ["a", "b", "c"], 6, seed=1)
    assert len(background.points) == 6 and sum(background.weights) == 600
    rows = planted.filter("id < 20").select("id", "a", "b", "c")
    values = attribution.shapley_values(rows, ["id"], ["a", "b", "c"], background, score, permutations=5, mode="exact" if exact else "sampled")
    total = {r["id"]: r["s"] for r in values.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    base = attribution.background_mean(background, score, spark)
    for r in score(rows).collect():
        assert abs(total[r["id"]] - (r["y_pred"] - base)) < 1e-9


def test_shapley_of_a_linear_score(spark, planted):
    w = {"a": 2.0, "b": -1.0, "c": 0.5}
    background = attribution.sampled_background(planted.filter("id < 9").select("a", "b", "c"), ["a", "b", "c"])
    mean = np.mean(background.points, axis=0)
    rows = planted.filter("id in (3, 77)").select("id", "a", "b", "c")
    for mode in ("exact", "sampled"):
        got = {(r["id"], r["feature"]): r["value"] for r in attribution.shapley_values(
            rows, ["id"], ["a", "b", "c"], background, lambda d: d.withColumn("y_pred", dot(w)), mode=mode).collect()}
        for r in rows.collect():
            for j, c in enumerate("abc"):
                assert abs(got[(r["id"], c)] - w[c] * (r[c] - mean[j])) < 1e-9
    with pytest.raises(ValueError, match="sampled"):
        attribution.shapley_values(rows, ["id"], [f"f{i}" for i in range(21)], background, None)


def test_local_surrogate_solves_the_weighted_ridge(spark, planted, monkeypatch):
    """Slopes against a direct solution on the same perturbed rows; the penalty shrinks them where weights are small."""
    rows = planted.filter("id < 5").select("id", "a", "b", "c")
    w, seen = {"a": 2.0, "b": -1.0, "c": 0.0}, []

    def score(d):
        seen.append(d)
        return d.withColumn("y_pred", dot(w, 1.0) + F.col("a") * F.col("b"))
    got = {(r["id"], r["feature"]): r["value"] for r in attribution.local_surrogate(
        rows, ["id"], ["a", "b", "c"], planted, score, 400).collect()}
    assert len(got) == 15
    stats = planted.agg(*[F.avg(c).alias(f"m{c}") for c in "abc"], *[F.stddev_pop(c).alias(f"s{c}") for c in "abc"]).first()
    mean, std = np.array([stats[f"m{c}"] for c in "abc"]), np.array([stats[f"s{c}"] for c in "abc"])
    own = rows.toPandas().set_index("id")
    for i, part in seen[0].toPandas().groupby("id"):
        x = part[["a", "b", "c"]].to_numpy()
        z = (x - mean) / std
        away = ((z - (own.loc[i].to_numpy() - mean) / std) ** 2).sum(1)
        assert len(z) == 400 and np.isclose(away.min(), 0) and abs(z.mean()) < 0.15 and abs(z.std() - 1) < 0.1
        k = np.sqrt(np.exp(-away / (3 * 0.75 ** 2)))
        y = 2 * x[:, 0] - x[:, 1] + 1 + x[:, 0] * x[:, 1]
        zc, yc = z - np.average(z, 0, k), y - np.average(y, weights=k)
        want = np.linalg.solve((zc * k[:, None]).T @ zc + np.eye(3), (zc * k[:, None]).T @ yc)
        assert np.allclose([got[(i, c)] for c in "abc"], want, atol=1e-8)
    monkeypatch.setattr(attribution, "SUM_COLUMNS", 1)
    for r in attribution.local_surrogate(rows, ["id"], ["a", "b", "c"], planted, score, 400).collect():
        assert abs(got[(r["id"], r["feature"])] - r["value"]) < 1e-8


def test_bootstrap_and_multi_output(planted):
    data = planted.withColumn("label", F.col("y"))
    draws = learners.bootstrap_draws(data, data.filter("id < 10"), ["id"], "linearregression", REGRESSION, 4, seed=1)
    got = evaluate.draw_summary(draws, ["id"], "y_pred").collect()
    assert len(got) == 10 and all(0 < r["y_unc"] < 0.2 for r in got)
    two = planted.withColumn("t", F.array("y", F.col("y") * 2))
    model = learners.fit_multi_output(two, "linearregression", "t", 2)
    row = evaluate.regression_metrics_multi(model.predict(two), "t", "y_pred").first()
    assert row["n_outputs"] == 2 and row["r2"] > 0.95


def test_importances_name_the_driving_feature(spark, planted):
    model = learners.fit(planted.withColumn("label", F.col("y")), "rf", REGRESSION, {"n_estimators": 10}, 1)
    rows = learners.tree_importances(model, ["a", "b", "c"], spark).collect()
    assert [r["feature"] for r in rows] == ["a", "b", "c"] and abs(sum(r["importance"] for r in rows) - 1) < 1e-9
