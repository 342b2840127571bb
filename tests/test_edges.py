import math

import pytest
from pyspark.sql import functions as F

from seriesml.config import Config
from seriesml.operators import clean, encode, evaluate, features, importance, learners, peaks, profile, scale, sequence, split
from seriesml.operators.ordering import series_layout


def series(spark, values, name="a"):
    return spark.createDataFrame([(name, i, v) for i, v in enumerate(values)], "s string, t int, v double")


def layout(df):
    return series_layout(df, ["s"], ["t"])


def column(df, name, order="t"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_series_shorter_than_window(spark):
    df = series(spark, [1.0, 2.0, 3.0])
    assert column(features.engineer(df, layout(df), {"mean": ["v"]}, {"mean": 5}), "v_mean") == [None] * 3
    assert sequence.sequences(df, layout(df), ["v"], ["v"], 5).count() == 0


def test_gradient_ends_and_single_row(spark):
    df = series(spark, [1.0, 4.0, 2.0]).union(series(spark, [7.0], "b"))
    got = {(r["s"], r["t"]): r["v_gradient"] for r in features.engineer(df, layout(df), {"gradient": ["v"]}).collect()}
    assert got == {("a", 0): 3.0, ("a", 1): 0.5, ("a", 2): -2.0, ("b", 0): None}


def test_missing_value_inside_a_window(spark):
    df = series(spark, [1.0, None, 3.0, 4.0, 5.0])
    assert column(features.engineer(df, layout(df), {"sum": ["v"]}, {"sum": 2}), "v_sum") == [None, None, None, 7.0, 9.0]


def test_nan_is_missing(spark):
    df = series(spark, [1.0, float("nan"), None, 2.0])
    assert column(clean.drop_missing(df), "v") == [1.0, 2.0]


def test_peak_plateau_and_ends(spark):
    df = series(spark, [5.0, 1.0, 3.0, 3.0, 3.0, 1.0, 0.0, 0.0, 9.0])
    assert [r["pos"] for r in peaks.peak_positions(df, layout(df), "v").collect()] == [3]
    assert column(peaks.peak_flags(df, layout(df), "v"), "is_peak") == [0, 0, 0, 1, 0, 0, 0, 0, 0]


def test_overlap_of_the_whole_window_moves_by_one_row(spark):
    df = series(spark, [float(i) for i in range(5)])
    got = sequence.input_sequences(df, layout(df), ["v"], 3, overlap=3).orderBy("sample").collect()
    assert [[v for (v,) in r["x"]] for r in got] == [[0, 1, 2], [1, 2, 3], [2, 3, 4]]


def test_target_larger_than_window(spark):
    df = series(spark, [1.0, 2.0])
    with pytest.raises(ValueError):
        sequence.sequences(df, layout(df), ["v"], ["v"], 2, target_size=3)


def test_future_target_beyond_the_end(spark):
    df = series(spark, [float(i) for i in range(7)])
    got = sequence.sequences(df, layout(df), ["v"], ["v"], 3, 2, 0, True).collect()
    assert [(r["sample"], r["y"]) for r in got] == [(0, [3.0, 4.0])]


@pytest.mark.parametrize("share,train", [(0.0, 0), (1.0, 10), (0.75, 7)])
def test_train_share(spark, share, train):
    df = series(spark, [float(i) for i in range(10)])
    got = split.split_rows(df, layout(df), share)
    assert got.filter("split = 'train'").count() == train
    assert column(got.filter("split = 'train'"), "t") == list(range(train))


def test_split_of_named_series(spark):
    df = spark.createDataFrame([(n, i) for n in ("b", "c", "a", "d") for i in range(2)], "s string, t int")
    got = split.split_series(df, "s", 0.5).select("s", "split").distinct().collect()
    assert {tuple(r) for r in got} == {("a", "train"), ("b", "train"), ("c", "test"), ("d", "test")}
    one, two = (split.split_series(df, "s", 0.5, seed).orderBy("s", "t").collect() for seed in (3, 3))
    assert one == two and sum(r["split"] == "train" for r in one) == 4


def test_seeded_sample_ignores_partitioning(spark):
    df = spark.range(1000)
    a = split.sample_rows(df.repartition(7), ["id"], 20, 5).collect()
    assert a == split.sample_rows(df.coalesce(1), ["id"], 20, 5).collect() and len(set(a)) == 20
    assert split.shuffle_rows(df, ["id"], 1).collect() == split.shuffle_rows(df.repartition(3), ["id"], 1).collect()
    shuffled = split.split_rows_shuffled(df, [], ["id"], 0.3, 9)
    assert shuffled.filter("split = 'train'").count() == 300
    assert shuffled.filter("split = 'train'").agg(F.max("id")).first()[0] > 300


def test_scalers_on_constants_and_train_only(spark):
    train = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, b double")
    other = spark.createDataFrame([(1.0, 8.0)], "a double, b double")
    for method, want in (("standard", (0.0, 5.0)), ("minmax", (0.0, 3.0)), ("robust", (0.0, 5.0)), ("none", (1.0, 8.0)), (None, (1.0, 8.0))):
        fitted = scale.fit_scaler(train, ["a", "b"], method)
        assert tuple(scale.apply_scaler(other, fitted).first()) == want
        assert tuple(scale.invert_scaler(scale.apply_scaler(other, fitted), fitted).first()) == (1.0, 8.0)
    assert scale.fit_target_scaler(train, ["b"], "standard", classification=True).centers == {}
    with pytest.raises(ValueError):
        scale.fit_scaler(train, ["a"], "unknown")


def test_labels(spark):
    df = spark.createDataFrame([("x",), ("z",), ("y",)], "c string")
    fitted = encode.fit_labels(df, "c")
    assert fitted.classes == ("x", "y", "z")
    unseen = spark.createDataFrame([("y",), ("q",), (None,)], "c string")
    assert [r["c"] for r in encode.encode_label(unseen, fitted).collect()] == [1, None, None]
    assert [tuple(r) for r in encode.one_hot(unseen, fitted).collect()] == [(0, 1, 0), (0, 0, 0), (0, 0, 0)]
    with pytest.raises(ValueError):
        encode.one_hot(df, encode.fit_labels(df.filter("c < 'z'"), "c"))
    many = encode.fit_labels(df, "c", inline_classes=2)
    assert many.table is not None
    assert {tuple(r) for r in encode.encode_label(unseen, many, "k").collect()} == {("y", 1), ("q", None), (None, None)}
    assert encode.encode_label(unseen, many).columns == ["c"]
    for made in (fitted, many):  # the same on both sides of the limit
        assert sorted(tuple(r) for r in encode.one_hot(unseen, made).collect()) == [(0, 0, 0), (0, 0, 0), (0, 1, 0)]
        assert sorted(r[0] for r in encode.one_hot_array(unseen, made).collect()) == [[0, 0, 0], [0, 0, 0], [0, 1, 0]]
    numbers = spark.createDataFrame([(30,), (7,), (7,), (12,)], "c int")
    coded = encode.encode_label(numbers, encode.fit_labels(numbers, "c", 1), "k").collect()
    assert {tuple(r) for r in coded} == {(7, 0), (12, 1), (30, 2)} and len(coded) == 4


def test_input_contract(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    assert features.check_inputs(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError, match="missing"):
        features.check_inputs(df, ["a", "z"])
    assert clean.drop_target(df, ["c", "not_there"]).columns == ["a", "b"]
    with pytest.warns(UserWarning):
        features.select_variables(df, ["a", "zz"])
    assert features.targets_first(df, ["c"]).columns == ["c", "a", "b"]


def test_index_column_is_dropped_unless_target(spark):
    df = spark.createDataFrame([("a", i, float(-i)) for i in range(4)], "s string, t int, v double")
    assert clean.drop_index_column(df, layout(df)).columns == ["s", "v"]
    assert clean.drop_index_column(df, layout(df), ["t"]).columns == ["s", "t", "v"]


def test_removable_columns_of_signed_and_absolute_correlation(spark):
    df = spark.createDataFrame([(float(i), float(-i), float(i % 3), 0.0 if i else 1.0) for i in range(30)],
                               "a double, minus double, y double, z double")
    assert clean.removable_columns(df, "y", 0.9, 0.95) == ["z"]
    assert clean.removable_columns(df, "y", 1.0, 0.95, absolute=True) == ["minus"]
    assert clean.removable_columns(df, "y", 1.0, 0.95, "spearman", True) == ["minus"]


def test_profile_of_empty_and_all_null_columns(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b double")
    flags = {r["column_name"]: r for r in profile.distinct_flags(df).collect()}
    assert flags["a"]["is_constant"] and flags["b"]["n_distinct"] == 0 and not flags["b"]["is_unique"]
    assert profile.quantile_summary(df, ["b"]).first()["q50"] is None
    empty = df.limit(0)
    assert profile.distinct_counts(empty, ["a", "b"]).count() == 2
    assert profile.overview(empty).first()["n_duplicate_rows"] == 0
    assert profile.histogram(empty, "a").count() == 0
    assert profile.pearson(df, ["a", "b"]).first()["correlation"] is None
    assert profile.categorical_variables(df) == ["a", "b"]


def test_skewed_column_alerts(spark):
    df = spark.range(1000).select(F.when(F.col("id") == 0, 1000.0).otherwise(0.0).alias("x"), F.col("id").cast("double").alias("y"))
    kinds = {(r["variable"], r["kind"]) for r in profile.alerts(df).collect()}
    assert ("x", "skewed") in kinds and ("x", "zeros") in kinds and ("y", "skewed") not in kinds


def test_metrics_limits(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "t double, p double")
    assert evaluate.regression_metrics(df, "t", "p").first()["r2"] == 1.0
    none = spark.createDataFrame([(0, 0)], "t int, p int")
    row = evaluate.classification_metrics(none, "t", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_weights_that_normalise_sum_to_one(spark):
    scores = spark.createDataFrame([("model_a.h5", 0.3), ("model_b.h5", -0.1), ("model_c.h5", 0.3)], "model string, score double")
    for method in ("normalize", "softmax", "exponential", "clip_negative", "square", "rank", "log", "something else"):
        total = importance.model_weights(scores, method).agg(F.sum("weight")).first()[0]
        assert math.isclose(total, 1.0, rel_tol=1e-12), method
    flat = scores.withColumn("score", F.lit(1.0))
    assert importance.model_weights(flat, "minmax").first()["weight"] is None


def test_missing_importance_removes_the_model(spark):
    rows = [("m_a", "x", 0.4), ("m_a", "y", 0.6), ("m_b", "x", 1.0), ("m_b", "y", None)]
    imp = spark.createDataFrame(rows, "model string, feature string, importance double")
    got = {r["feature"]: r["importance"] for r in importance.combine_importances(imp).collect()}
    assert got == {"x": 0.4, "y": 0.6}
    assert importance.complete_models(imp) == ["m_a"]


def test_methods_and_tasks():
    learners.check_method("lda", "classification")
    with pytest.raises(ValueError):
        learners.check_method("lasso", "classification")
    with pytest.raises(ValueError):
        learners.check_method("qda", "regression")
    with pytest.raises(NotImplementedError):
        learners.check_method("transformer", "regression")


def test_config_checks():
    cfg = Config.from_mapping({"clean": {"target": "y"}, "featurize": {"add_sum": ["a"], "rolling_window_size_sum": 4}})
    assert cfg.featurize.requests() == {"sum": ["a"]} and cfg.featurize.lengths()["sum"] == 4
    assert sequence.effective_target_size(5, True) == 1 and sequence.effective_target_size(5, False) == 5
    for bad in ({"clean": {"percentage_zeros_threshold": 2}}, {"clean": {"input_max_correlation_threshold": -1}},
                {"split": {"train_split": 1.5}}, {"train": {"dropout": -0.1}}, {"train": {"learning_method": "cnnx"}},
                {"explain": {"explanation_method": "x"}}, {"nope": {}}, {"clean": {"nope": 1}}):
        with pytest.raises(ValueError):
            Config.from_mapping(bad)


def test_flat_names_follow_time():
    assert sequence.flat_names(["a", "b"], 2) == ["a_0", "b_0", "a_1", "b_1"]
    assert sequence.flat_names(["a"], 1) == ["a"]


def test_chi_squared_tail():
    from seriesml.functions.statistics import chi_squared_tail
    # Tabled values.
    for x, dof, p in ((3.841459, 1, 0.05), (9.487729, 4, 0.05), (0.710723, 4, 0.95), (18.307038, 10, 0.05), (23.209251, 10, 0.01)):
        assert abs(chi_squared_tail(x, dof) - p) < 1e-6
    assert chi_squared_tail(0.0, 3) == 1.0 and abs(chi_squared_tail(2 * math.log(2), 2) - 0.5) < 1e-12


def test_uniform_and_boolean_text(spark):
    df = spark.range(400).select(F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d")), (F.col("id") % 4 + 1).cast("int")).alias("even"),
                                 F.when(F.col("id") % 10 == 0, "Yes").otherwise("no").alias("flag"))
    assert [(r["variable"], r["kind"]) for r in profile.alerts(df).collect()] == [("even", "uniform")]
    assert {r["column_name"]: r["inferred_type"] for r in profile.column_types(df).collect()} == {"even": "categorical", "flag": "boolean"}
