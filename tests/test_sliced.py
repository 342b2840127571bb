"""Long series are cut into slices; results must equal those of one window over the series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesml.operators import clean, features, ordering, peaks, profile, sequence, split
from seriesml.operators.ordering import carry_forward, dense_index, neighbours, series_layout, series_stats
from seriesml.operators.quantiles import exact_quantiles

LIMIT = 40


@pytest.fixture(scope="module")
def skewed(spark):
    """One series has most rows; values repeat, so that plateaus and ties occur."""
    rng = np.random.default_rng(5)
    sizes = {"a": 700, "b": 30, "c": 1, "d": 90}
    rows = [(s, int(t * 3 + len(s)), float(np.round(rng.normal(), 1))) for s, n in sizes.items() for t in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame([(str(s), int(t), float(v)) for s, t, v in rows], "s string, t bigint, v double").cache()


def layouts(df, order=("t",), series=("s",)):
    plain, cut = series_layout(df, series, order), series_layout(df, series, order, LIMIT)
    assert not plain.sliced and cut.sliced
    return plain, cut


def same(a, b):
    cols = sorted(a.columns)
    x = sorted(map(repr, a.select(*cols).collect()))
    y = sorted(map(repr, b.select(*cols).collect()))
    assert x == y


@pytest.mark.parametrize("series", [("s",), ()])
def test_dense_index(skewed, series):
    plain, cut = layouts(skewed, ("t", "s"), series)
    same(dense_index(skewed, plain, "i", "n"), dense_index(skewed, cut, "i", "n"))


def test_hot_series_by_join(skewed):
    """Two series columns take the join instead of the inline list."""
    df = skewed.withColumn("z", F.length("s"))
    plain, cut = layouts(df, ("t",), ("s", "z"))
    assert cut.hot_table is not None
    same(dense_index(df, plain, "i"), dense_index(df, cut, "i"))


def test_features(skewed):
    plain, cut = layouts(skewed)
    lengths = {"sum": 7, "mean": 60, "max_min": 5, "standard_deviation": 9}
    a = features.engineer_all(skewed, plain, ["v"], lengths, peak_mean_length=20)
    b = features.engineer_all(skewed, cut, ["v"], lengths, peak_mean_length=20)
    rounded = [F.round(c, 9).alias(c) if c.startswith("v_") else c for c in a.columns]
    same(a.select(*rounded), b.select(*rounded))


def test_neighbours_and_carry(skewed):
    plain, cut = layouts(skewed)
    thin = dense_index(skewed, plain).filter((F.col("_i") % 97 == 3) | (F.col("_i") < 5)).withColumn(
        "m", F.when(F.col("v") > 0, F.col("v")))
    same(neighbours(thin, plain, "_i", ["t", "v"]), neighbours(thin, cut, "_i", ["t", "v"]))
    same(carry_forward(thin, plain, "_i", "m", "h"), carry_forward(thin, cut, "_i", "m", "h"))


def test_split_samples_and_stats(skewed):
    plain, cut = layouts(skewed)
    same(split.split_rows(skewed, plain, 0.7), split.split_rows(skewed, cut, 0.7))
    for overlap, future in ((0, False), (4, True), (9, False)):
        a, b = (sequence.sequences(skewed, x, ["v"], ["v"], 6, 2, overlap, future) for x in (plain, cut))
        same(a, b)
    aggs = {"n": F.count("v"), "m": F.max("v")}
    same(series_stats(skewed, plain, aggs), series_stats(skewed, cut, aggs))
    same(clean.monotonic_columns(skewed, plain, ["t", "v"]), clean.monotonic_columns(skewed, cut, ["t", "v"]))


def brute_peaks(v, distance):
    found, i = [], 1
    while i < len(v) - 1:
        if v[i - 1] < v[i]:
            j = i
            while j < len(v) - 1 and v[j + 1] == v[i]:
                j += 1
            if j < len(v) - 1 and v[j + 1] < v[i]:
                found.append((i + j) // 2)
            i = j + 1
        else:
            i += 1
    kept = []
    for p in sorted(found, key=lambda p: (-v[p], -p)):
        if all(abs(p - q) >= distance for q in kept):
            kept.append(p)
    return sorted(kept)


@pytest.mark.parametrize("small,block", [(64, 1000), (1, 24), (0, 40)])
def test_peaks_by_brute_force(spark, skewed, small, block):
    plain, cut = layouts(skewed)
    want = {(s, p) for s, g in skewed.toPandas().sort_values("t").groupby("s") for p in brute_peaks(g["v"].tolist(), 5)}
    for layout in (plain, cut):
        found = peaks.peak_candidates(dense_index(skewed, layout), layout, "v")
        got = peaks.suppress_close(found, layout, 5, small, block).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_peaks_of_an_alternating_signal(spark):
    """Equal heights two apart form one chain over the whole series."""
    v = [float(i % 2) for i in range(301)] + [5.0, 5.0, 5.0, 0.0, 3.0, 0.0]
    df = spark.createDataFrame(list(enumerate(v)), "t bigint, v double")
    layout = series_layout(df, (), ("t",))
    got = [r["pos"] for r in peaks.suppress_close(
        peaks.peak_candidates(dense_index(df, layout), layout, "v"), layout, 5, 8, 60).orderBy("pos").collect()]
    assert got == brute_peaks(v, 5)


def test_average_ranks(skewed):
    want = skewed.toPandas()
    want["r"] = want["v"].rank()
    got = profile.average_ranks(skewed, "v", "r", 7).toPandas()
    key = ["s", "t"]
    assert np.allclose(want.sort_values(key)["r"], got.sort_values(key)["r"])


@pytest.mark.parametrize("values", ["normal", "few", "constant", "spread"])
def test_quantiles(spark, values):
    rng = np.random.default_rng(1)
    x = {"normal": rng.normal(size=5000), "few": rng.integers(0, 3, 5000).astype(float), "constant": np.ones(5000),
         "spread": np.concatenate([np.exp(rng.normal(size=3000) * 5), np.zeros(2000)])}[values]
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": -x})).repartition(3)
    shares = [0.0, 0.05, 0.25, 0.5, 0.777, 0.95, 1.0]
    for direct, window in ((10_000, 1), (10, 20), (10, 1000)):
        got = exact_quantiles(df, ["x", "y"], shares, direct, window)
        assert np.allclose(got["x"], np.quantile(x, shares), rtol=1e-12, atol=1e-12)
        assert np.allclose(got["y"], np.quantile(-x, shares), rtol=1e-12, atol=1e-12)


def test_quantiles_of_numbers_side_by_side(spark):
    low = 0.02
    x = np.repeat([low, np.nextafter(low, 1), np.nextafter(np.nextafter(low, 1), 1), 0.03], [30, 40, 25, 5])
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(3)
    shares = [0.0, 0.29, 0.3, 0.5, 0.69, 0.7, 0.9, 1.0]
    assert np.array_equal(exact_quantiles(df, ["x"], shares, 10, 5)["x"], exact_quantiles(df, ["x"], shares)["x"])
    ends = np.repeat([-np.inf, 1.0, np.inf], 30)
    got = exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": ends})).repartition(3), ["x"], [0.0, 0.1, 0.5, 0.9, 1.0], 10, 5)
    assert got["x"] == [-np.inf, -np.inf, 1.0, np.inf, np.inf]
    away = profile.numeric_summary(spark.createDataFrame(pd.DataFrame({"x": np.tile([0.03, 0.05, 0.07, 0.1], 50)})), ["x"], 10).first()
    assert abs(away["mad"] - 0.02) < 1e-12


ORDERS = {
    "text": ("concat('k', lpad(cast(t as string), 6, '0'), 'é')", "s"),
    "milliseconds": ("timestampadd(MILLISECOND, t, timestamp_ntz'2024-02-29 23:59:59.5')", "t % 5"),
    "one_first_value": ("cast(7 as int)", "t"),
    "two_first_values": ("cast(if(t % 5 = 0, null, 3) as double)", "concat('x', lpad(cast(t as string), 6, '0'))"),
    "decimal_then_date": ("cast(t div 300 as decimal(20,2)) / 7", "date_add(date'2020-01-01', cast(t as int))"),
}


@pytest.mark.parametrize("name", ORDERS)
@pytest.mark.parametrize("series", [("s",), ()])
def test_slices_by_the_whole_order(skewed, name, series):
    first, second = ORDERS[name]
    df = skewed.selectExpr("s", "t", "v", f"{first} AS o1", f"{second} AS o2", "s AS o3")
    plain, cut = layouts(df, ("o1", "o2", "o3"), series)
    assert cut.bounds
    sliced = ordering._sliced(df, cut).groupBy(*series, "_slice").count()
    assert sliced.agg(F.max("count")).first()[0] <= 2 * LIMIT
    same(dense_index(df, plain, "i", "n"), dense_index(df, cut, "i", "n"))
    lengths = {"sum": 5, "mean": 5, "max_min": 4, "standard_deviation": 6}
    same(features.engineer(df, plain, {"mean": ["v"], "gradient": ["v"]}, lengths), features.engineer(df, cut, {"mean": ["v"], "gradient": ["v"]}, lengths))
    same(split.split_rows(df, plain, 0.6), split.split_rows(df, cut, 0.6))


def test_many_bounds_in_two_steps(spark):
    df = spark.range(6000).selectExpr("concat('a', lpad(cast(id as string), 5, '0')) AS o")
    plain, cut = series_layout(df, (), ("o",)), series_layout(df, (), ("o",), 60)
    assert len(cut.bounds) > 64 and cut.bounds == tuple(sorted(cut.bounds))
    at = ordering._sliced(df, cut)
    import bisect
    keys = [b[0] for b in cut.bounds]
    assert all(r["_slice"] == bisect.bisect_right(keys, r["o"]) for r in at.collect())
    same(dense_index(df, plain, "i"), dense_index(df, cut, "i"))
