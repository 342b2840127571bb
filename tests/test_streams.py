"""Streams cut into many micro-batches give the rows of the batch operators."""

import pytest
from pyspark.sql import functions as F

from seriesml.operators import features, sequence
from seriesml.operators.ordering import series_layout
from seriesml.streaming import runs, stateful


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Five files of rows in order, named so that they arrive in order."""
    folder = tmp_path_factory.mktemp("parts")
    df = spark.range(400).select((F.col("id") % 3).alias("s"), F.col("id").alias("t"), F.sin("id").alias("v"), (F.col("id") * 2.0).alias("u"))
    import time
    for i in range(5):
        df.filter((F.col("t") >= i * 80) & (F.col("t") < (i + 1) * 80)).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return str(folder), df


def stream(spark, parts):
    return runs.read_files(spark, parts[0], parts[1].schema, files_per_trigger=1)


@pytest.mark.parametrize("feature", ["mean", "standard_deviation", "maximum", "minimum", "sum"])
def test_rolling_over_micro_batches(spark, parts, feature):
    df = parts[1]
    got = runs.run_available(stateful.rolling_stream(stream(spark, parts), "s", "t", "v", feature, 7), "r").orderBy("t").collect()
    lengths = {"sum": 7, "mean": 7, "max_min": 7, "standard_deviation": 7}
    want = features.engineer(df, series_layout(df, ["s"], ["t"]), {feature: ["v"]}, lengths).orderBy("t").collect()
    assert len(got) == len(want) == 400 and not any(r["late"] for r in got)
    for a, b in zip(got, want):
        x, y = a[f"v_{feature}"], b[f"v_{feature}"]
        assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-9)


def test_samples_over_micro_batches(spark, parts):
    df = parts[1]
    got = runs.run_available(stateful.sample_stream(stream(spark, parts), "s", "t", ["v", "u"], 9, 4), "q")
    want = sequence.input_sequences(df, series_layout(df, ["s"], ["t"]), ["v", "u"], 9, 4)
    assert not got.filter("late").count()
    assert got.drop("late").orderBy("s", "sample").collect() == want.orderBy("s", "sample").collect()


def test_late_rows_of_samples_come_out(spark, tmp_path):
    import time
    for rows in ([(0, 0), (1, 0), (1, 1), (4, 0)], [(1, 1), (3, 9), (5, 0)]):
        spark.createDataFrame([("a", i, j, float(10 * i + j)) for i, j in rows], "s string, t bigint, u bigint, v double").coalesce(1).write.mode("append").parquet(str(tmp_path))
        time.sleep(0.05)
    made = runs.read_files(spark, str(tmp_path), spark.read.parquet(str(tmp_path)).schema, files_per_trigger=1)
    got = runs.run_available(stateful.sample_stream(made, "s", ["t", "u"], ["v"], 2), "late").collect()
    assert sorted((r["sample"], r["x"]) for r in got if not r["late"]) == [(0, [[0.0], [10.0]]), (1, [[11.0], [40.0]])]
    assert sorted((r["sample"], r["x"]) for r in got if r["late"]) == [(None, [[11.0]]), (None, [[39.0]])]


def test_late_rows_are_marked(spark, tmp_path):
    import time
    for ids in ([0, 1, 2, 5], [3, 6, 6]):
        spark.createDataFrame([("a", i, float(i)) for i in ids], "s string, t bigint, v double").coalesce(1).write.mode("append").parquet(str(tmp_path))
        time.sleep(0.05)
    rows = runs.read_files(spark, str(tmp_path), spark.read.parquet(str(tmp_path)).schema, files_per_trigger=1)
    got = runs.run_available(stateful.rolling_stream(rows, "s", "t", "v", "sum", 2), "late").collect()
    assert sorted((r["t"], r["v_sum"], r["late"]) for r in got if not r["late"] and r["v_sum"] is not None) == [
        (1, 1.0, False), (2, 3.0, False), (5, 7.0, False), (6, 11.0, False)]
    assert sorted(r["t"] for r in got if r["late"]) == [3, 6]
