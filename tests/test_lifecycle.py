import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesml.config import Config
from seriesml.operators import importance
from seriesml.plans import lifecycle


@pytest.fixture(scope="module")
def recorded(spark):
    """Eight recorded series; the target follows two inputs, the class follows one."""
    rng = np.random.default_rng(4)
    frames = []
    for s in range(8):
        n = 150
        a, b = rng.normal(size=n), rng.normal(size=n)
        frames.append(pd.DataFrame({"series_id": s, "t": range(n), "a": a, "b": b, "flat": 1.0, "twin": 2 * a, "word": "w",
                                    "y": 3 * a - b + 10, "kind": np.where(a > 0, "up", "down")}))
    return spark.createDataFrame(pd.concat(frames)).cache()


def config(**sections):
    base = {"clean": {"target": "y", "input_max_correlation_threshold": 0.95, "percentage_zeros_threshold": 0.9},
            "sequentialize": {"window_size": 1}, "scale": {"input_method": "standard", "output_method": "standard"}}
    for name, values in sections.items():
        base[name] = {**base.get(name, {}), **values}
    return Config.from_mapping(base)


def test_regression_and_inference(spark, recorded):
    cfg = config(train={"learning_method": "linearregression"}, featurize={"add_mean": ["a"], "rolling_window_size_mean": 3})
    df = recorded.drop("kind")
    fitted = lifecycle.fit(df, cfg, ["series_id"], ["t"])
    assert fitted.catalogue.removed == ("flat", "twin", "word") and fitted.catalogue.inputs == ("a", "b", "a_mean")
    row = fitted.metrics.first()
    assert row["r2"] > 0.99 and row["n"] == 3 * 148
    got = fitted.transform(df.drop("y"))
    truth = df.filter("t >= 2").select("series_id", (F.col("t") - 2).alias("sample"), "y")
    worst = got.join(truth, ["series_id", "sample"]).agg(F.max(F.abs(F.col("y") - F.col("y_pred"))), F.count("y")).first()
    assert worst[0] < 1e-6 and worst[1] == 8 * 148
    with pytest.raises(ValueError, match="missing"):
        fitted.transform(df.drop("b"))


@pytest.mark.parametrize("method", ["dt", "lda", "qda", "kn"])
def test_classification(recorded, method):
    cfg = config(clean={"target": "kind", "classification": True}, train={"learning_method": method})
    fitted = lifecycle.fit(recorded.drop("y"), cfg, ["series_id"], ["t"])
    assert fitted.encoding.classes == ("down", "up")
    assert fitted.metrics.first()["accuracy"] > 0.9
    got = fitted.transform(recorded.drop("y", "kind"))
    assert got.count() == 1200 and {r[0] for r in got.select("y_pred").distinct().collect()} == {0, 1}


def test_windows_several_steps_and_one_series(recorded):
    cfg = config(train={"learning_method": "ridgeregression"}, sequentialize={"window_size": 6, "overlap": 2, "target_size": 3},
                 split={"train_split": 0.6})
    fitted = lifecycle.fit(recorded.filter("series_id = 2").drop("kind"), cfg, ["series_id"], ["t"])
    row = fitted.metrics.first()
    assert row["n_outputs"] == 3 and row["r2"] > 0.9
    got = fitted.transform(recorded.filter("series_id = 3").drop("kind"))
    assert got.count() == 37 and len(got.first()["y_pred"]) == 3


def test_ensemble_explained_and_combined(spark, recorded):
    cfg = config(train={"ensemble": True, "params": {"n_estimators": 3, "max_depth": 4}},
                 evaluate={"threshold_for_ensemble_models": 0.3},
                 explain={"explanation_method": "all", "number_of_summary_samples": 5, "number_of_background_samples": 4})
    fitted = lifecycle.fit(recorded.drop("kind"), cfg, ["series_id"], ["t"])
    assert fitted.metrics.count() == 6
    imp = lifecycle.explain(fitted, spark).cache()
    got = importance.combine_importances(imp, lifecycle.scores(fitted), "weighted", "softmax").collect()
    assert got[0]["feature"] == "a" and abs(sum(r["importance"] for r in got) - 1) < 1e-9
    models = importance.complete_models(imp)
    assert len(models) >= 2
    score = importance.agreement_score(importance.agreement_matrix(imp, models, "pearson")).first()
    assert score["agreement_std"] is not None


def test_uncertainty(recorded):
    cfg = config(train={"learning_method": "linearregression"}, evaluate={"uncertainty_estimation_sampling_size": 4})
    fitted = lifecycle.fit(recorded.drop("kind"), cfg, ["series_id"], ["t"])
    got = lifecycle.uncertainty(fitted).collect()
    assert len(got) == 450 and all(r["lower"] <= r["y_pred"] <= r["upper"] for r in got)
    cfg = config(clean={"target": "kind", "classification": True}, train={"learning_method": "dt"},
                 evaluate={"uncertainty_estimation_sampling_size": 3})
    fitted = lifecycle.fit(recorded.drop("y"), cfg, ["series_id"], ["t"])
    got = lifecycle.uncertainty(fitted).collect()
    assert len(got) == 450 and sum(r["y_true"] == r["y_pred"] for r in got) > 400 and all(r["y_unc"] >= -1e-9 for r in got)


def test_one_hot_of_two_classes_is_refused(recorded):
    cfg = config(clean={"target": "kind", "classification": True, "onehot_encode_target": True})
    with pytest.raises(ValueError, match="one-hot"):
        lifecycle.fit(recorded.drop("y"), cfg, ["series_id"], ["t"])


def test_the_shipped_parameter_file_is_accepted():
    given = {"evaluate": {"dropout_uncertainty_estimation": True, "show_inputs": True, "threshold_for_ensemble_models": -1000},
             "train": {"activation_function": "relu", "n_heads": 4, "unit_type": "LSTM", "patience": 50, "dropout": 0.1, "learning_method": "xgboost",
                       "n_neurons": [16, 16]}, "clean": {"combine_files": False}, "explain": {"generate_explanations": True}}
    made = Config.from_mapping(given)
    assert made.evaluate.uncertainty_estimation and made.train.n_neurons == [16, 16]
    assert set(made.unused) == {"train.activation_function", "train.n_heads", "train.unit_type", "train.patience", "train.dropout",
                                "evaluate.show_inputs", "explain.generate_explanations"}
    with pytest.raises(ValueError, match="unknown"):
        Config.from_mapping({"train": {"heads": 4}})


def test_neighbours_of_repeated_and_nameless_rows(spark):
    rows = [(None, i, "train", [float(i)], [float(i)]) for i in range(20)]
    train = spark.createDataFrame(rows, "g string, sample long, split string, x array<double>, y array<double>")
    cfg = config(train={"learning_method": "kn", "params": {"n_neighbors": 1}})
    predictor = lifecycle._fit_predictor(train, "kn", "regression", 1, cfg, ["g"])
    asked = spark.createDataFrame([("a", 0, [17.2]), ("a", 0, [2.1]), (None, 0, [5.0]), (None, 0, [9.0])], "g string, sample long, x array<double>")
    got = {(r["x"][0], r["p"]) for r in predictor.predict(asked, "p").collect()}
    assert got == {(17.2, 17.0), (2.1, 2.0), (5.0, 5.0), (9.0, 9.0)}
