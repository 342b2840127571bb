"""Streams whose state is a table: many micro-batches give the rows of the batch operators, restarts repeat nothing."""

import os
import time

import pytest
from pyspark.sql import functions as F

from seriesml.operators import features, sequence
from seriesml.operators.ordering import ROWS_PER_TASK_CONF, series_layout
from seriesml.streaming import runs, tables


def files(spark, folder, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return lambda: runs.read_files(spark, str(folder), spark.createDataFrame([], schema).schema, files_per_trigger=1)


def numbers(spark, tmp_path):
    rows = [(i % 3, i, float(i * i % 17), 2.0 * i) for i in range(400)]
    schema = "s bigint, t bigint, v double, u double"
    batches = [[r for r in rows[a:a + 80] if r[0] != 2 or a != 160] for a in range(0, 400, 80)]
    batches[1] = batches[1][::-1]  # within a batch rows come in any order
    return files(spark, tmp_path / "in", batches, schema), spark.createDataFrame(sum(batches, []), schema)


@pytest.mark.parametrize("feature", ["mean", "standard_deviation", "maximum", "sum"])
def test_rolling(spark, tmp_path, feature):
    stream, df = numbers(spark, tmp_path)
    got = tables.rolling_table(stream(), f"{tmp_path}/run", "s", "t", "v", feature, 7).orderBy("s", "t").collect()
    lengths = {"sum": 7, "mean": 7, "max_min": 7, "standard_deviation": 7}
    want = features.engineer(df, series_layout(df, ["s"], ["t"]), {feature: ["v"]}, lengths).orderBy("s", "t").collect()
    assert len(got) == len(want) and not any(r["late"] for r in got)
    for a, b in zip(got, want):
        x, y = a[f"v_{feature}"], b[f"v_{feature}"]
        assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-9)


@pytest.mark.parametrize("window,overlap", [(9, 4), (5, 0), (4, 9), (50, 10)])
def test_samples(spark, tmp_path, window, overlap):
    stream, df = numbers(spark, tmp_path)
    got = tables.sample_table(stream(), f"{tmp_path}/run", "s", "t", ["v", "u"], window, overlap)
    want = sequence.input_sequences(df, series_layout(df, ["s"], ["t"]), ["v", "u"], window, overlap)
    assert not got.filter("late").count()
    assert got.drop("late").orderBy("s", "sample").collect() == want.orderBy("s", "sample").collect()


def test_late_rows_come_out(spark, tmp_path):
    schema = "s string, t bigint, u bigint, v double"
    batches = [[("a", i, j, float(10 * i + j)) for i, j in rows] for rows in ([(0, 0), (1, 0), (1, 1), (4, 0)], [(1, 1), (3, 9), (5, 0), (5, 0)])]
    stream = files(spark, tmp_path / "in", batches, schema)
    got = tables.sample_table(stream(), f"{tmp_path}/samples", "s", ["t", "u"], ["v"], 2).collect()
    assert sorted((r["sample"], r["x"]) for r in got if not r["late"]) == [(0, [[0.0], [10.0]]), (1, [[11.0], [40.0]])]
    assert sorted(r["x"] for r in got if r["late"]) == [[[11.0]], [[39.0]], [[50.0]]]
    got = tables.rolling_table(stream(), f"{tmp_path}/rolling", "s", ["t", "u"], "v", "sum", 2).collect()
    assert sorted((r["t"], r["u"], r["v_sum"]) for r in got if not r["late"] and r["v_sum"] is not None) == [(1, 0, 10.0), (1, 1, 21.0), (4, 0, 51.0), (5, 0, 90.0)]


def test_a_million_rows_of_one_series_in_slices(spark, tmp_path):
    """No task windows more than a slice of the series."""
    n = 1_000_000
    spark.range(n).select(F.lit(1).cast("bigint").alias("s"), F.col("id").alias("t"), (F.col("id") % 11).cast("double").alias("v")).coalesce(1).write.parquet(f"{tmp_path}/in")
    spark.conf.set(ROWS_PER_TASK_CONF, "100000")
    try:
        stream = runs.read_files(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
        got = tables.rolling_table(stream, f"{tmp_path}/run", "s", "t", "v", "sum", 11)
        row = got.agg(F.count("*").alias("n"), F.min("v_sum").alias("a"), F.max("v_sum").alias("b"), F.count("v_sum").alias("full")).first()
    finally:
        spark.conf.unset(ROWS_PER_TASK_CONF)
    assert tuple(row) == (n, 55.0, 55.0, n - 10)
    assert spark.read.parquet(f"{tmp_path}/run/state/0").count() == 10


def test_dead_series_are_forgotten(spark, tmp_path):
    schema = "s string, t bigint, v double"
    batches = [[("a", 0, 1.0), ("b", 0, 1.0)], [("a", 50, 2.0)], [("a", 200, 3.0)], [("b", 205, 5.0), ("b", 206, 6.0), ("a", 60, 9.0)]]
    stream = files(spark, tmp_path / "in", batches, schema)
    got = tables.rolling_table(stream(), f"{tmp_path}/run", "s", "t", "v", "sum", 2, tables.Expiry("t", 100)).collect()
    by = {(r["s"], r["t"]): (r["v_sum"], r["late"]) for r in got}
    assert by["b", 205] == (None, False) and by["b", 206] == (11.0, False)  # begins anew
    assert by["a", 200] == (5.0, False) and by["a", 60] == (None, True)
    assert sorted(os.listdir(tmp_path / "run" / "state")) == ["2", "3"] and not os.listdir(tmp_path / "run" / "work")


@pytest.mark.parametrize("broken", ["state", "seen"])
def test_a_batch_that_failed_before_its_commit_is_repeated(spark, tmp_path, monkeypatch, broken):
    """The second batch writes its output and dies; the restart replaces it."""
    stream, df = numbers(spark, tmp_path)
    real, calls = tables._alive, []

    def alive(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)
    if broken == "state":
        monkeypatch.setattr(tables, "_alive", alive)
    else:
        gone = tables.remove
        monkeypatch.setattr(tables, "remove", lambda s, p: (_ for _ in ()).throw(RuntimeError("lost")) if p.endswith("work/1") and not calls.append(1) and len(calls) == 1 else gone(s, p))
    with pytest.raises(Exception, match="lost"):
        tables.rolling_table(stream(), f"{tmp_path}/run", "s", "t", "v", "mean", 7)
    assert os.path.exists(tmp_path / "run" / "out" / "batch=1")
    got = tables.rolling_table(stream(), f"{tmp_path}/run", "s", "t", "v", "mean", 7)
    assert got.count() == df.count() == got.select("s", "t").distinct().count() and not got.filter("late").count()


def test_replacing_sink(spark, tmp_path):
    stream, df = numbers(spark, tmp_path)
    once = tables.replacing_table(stream(), f"{tmp_path}/run")
    assert once.count() == df.count()
    again = tables.replacing_table(stream(), f"{tmp_path}/run")  # nothing new
    assert again.count() == df.count() and again.columns == df.columns
