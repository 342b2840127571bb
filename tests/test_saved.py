"""A fitted run that is saved and loaded in another session transforms as before, whatever the method."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesml.config import Config
from seriesml.plans import lifecycle, saved


@pytest.fixture(scope="module")
def recorded(spark):
    rng = np.random.default_rng(4)
    frames = [pd.DataFrame({"s": s, "t": range(60), "a": rng.normal(size=60), "b": rng.normal(size=60)}) for s in range(4)]
    df = pd.concat(frames)
    df["y"], df["kind"] = 3 * df["a"] - df["b"] + 10, np.where(df["a"] > 0.4, "up", np.where(df["a"] < -0.4, "down", "level"))
    return spark.createDataFrame(df).cache()


def rows(df):
    return sorted((r["s"], r["sample"], r["method"], str(np.round(r["y_pred"], 9))) for r in df.collect())


CASES = [(m, False, {}) for m in ("linearregression", "dt", "kn", "gb")] + [(m, True, {}) for m in ("dt", "lda", "qda", "kn", "svm", "dnn")] + [
    ("ridgeregression", False, {"sequentialize": {"window_size": 4, "target_size": 2}}), ("rf", False, {"train": {"ensemble": True}})]


@pytest.mark.parametrize("method,classes,more", CASES)
def test_round_trip(spark, recorded, tmp_path, method, classes, more):
    sections = {"clean": {"target": "kind" if classes else "y", "classification": classes}, "sequentialize": {"window_size": 2},
                "scale": {"input_method": "standard", "output_method": "minmax"}, "featurize": {"add_mean": ["a"], "rolling_window_size_mean": 3}}
    for name, values in {"train": {"learning_method": method, "params": {"n_estimators": 3} if method in ("gb", "rf") else {}}, **more}.items():
        sections[name] = {**sections.get(name, {}), **values}
    if more.get("train"):
        sections["train"]["params"] = {"n_estimators": 2, "max_depth": 2}
    df = recorded.drop("y" if classes else "kind")
    fitted = lifecycle.fit(df, Config.from_mapping(sections), ["s"], ["t"])
    saved.save_fitted(fitted, spark, str(tmp_path), "one")
    loaded = saved.load_fitted(spark.newSession(), str(tmp_path), "one")
    new = df.drop("y", "kind")
    assert rows(loaded.transform(new)) == rows(fitted.transform(new))
    assert loaded.config == fitted.config and loaded.catalogue == fitted.catalogue and loaded.encoding == fitted.encoding
    assert (loaded.input_scaler, loaded.target_scaler) == (fitted.input_scaler, fitted.target_scaler)
    assert sorted(map(str, loaded.metrics.collect())) == sorted(map(str, fitted.metrics.collect()))


def test_rows_name_their_model(spark, recorded, tmp_path):
    df = recorded.drop("kind")
    both = {}
    for name, method in (("first", "linearregression"), ("second", "dt")):
        cfg = Config.from_mapping({"clean": {"target": "y"}, "sequentialize": {"window_size": 1}, "train": {"learning_method": method}})
        both[name] = lifecycle.fit(df, cfg, ["s"], ["t"])
        saved.save_fitted(both[name], spark, str(tmp_path), name)
    asked = df.drop("y").withColumn("model_id", F.when(F.col("s") < 2, "first").otherwise("second"))
    got = saved.predict_saved(spark, str(tmp_path), asked)
    want = rows(both["first"].transform(df.drop("y").filter("s < 2"))) + rows(both["second"].transform(df.drop("y").filter("s >= 2")))
    assert rows(got) == sorted(want) and {r[0] for r in got.select("model_id").distinct().collect()} == {"first", "second"}
    with pytest.raises(ValueError, match="no row names a model"):
        saved.predict_saved(spark, str(tmp_path), asked.limit(0))
