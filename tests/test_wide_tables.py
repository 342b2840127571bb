"""Duplicates by hashes first, stored sketches, and tables laid out by series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesml.config import Config
from seriesml.operators import features, ordering, profile, quantiles, scale, sequence, split
from seriesml.plans import lifecycle
from seriesml.sources import sinks


def exchanged(df):
    """Columns that go through a hash exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.fixture
def copies(spark):
    rows = [(i % 40, f"text {i % 40}", None if i % 40 == 3 else float(i % 40)) for i in range(60)] + [(100 + i, "x" * i, float("nan") if i % 2 else -0.0) for i in range(30)]
    return spark.createDataFrame(rows + [(7, "text 7", 7.0)] * 5, "a int, b string, c double")


def test_duplicates(spark, copies):
    row = profile.overview(copies).first()
    distinct = copies.distinct().count()
    assert row["n_rows"] == 95 and row["n_duplicate_rows"] == 95 - distinct and row["n_missing_cells"] == copies.filter("c IS NULL").count()
    got = [tuple(r) for r in profile.duplicate_rows(copies, 3).collect()]
    assert got == [(7, "text 7", 7.0, 7), (0, "text 0", 0.0, 2), (1, "text 1", 1.0, 2)]
    assert profile.duplicate_rows(copies.limit(0)).collect() == [] and profile.overview(copies.limit(0)).first()["n_duplicate_rows"] == 0
    single = copies.distinct()
    assert profile.duplicate_rows(single).collect() == [] and profile.overview(single).first()["n_duplicate_rows"] == 0


def test_rows_whose_hashes_meet_are_told_apart(spark, copies, monkeypatch):
    monkeypatch.setattr(profile, "_row_hashes", lambda df: df.withColumns({"_h1": F.lit(1).cast("bigint") * (F.col("a") % 3), "_h2": F.lit(1).cast("bigint")}))
    assert profile.overview(copies).first()["n_duplicate_rows"] == 95 - copies.distinct().count()
    assert [tuple(r) for r in profile.duplicate_rows(copies, 3).collect()] == [(7, "text 7", 7.0, 7), (0, "text 0", 0.0, 2), (1, "text 1", 1.0, 2)]


def test_only_hashes_are_shuffled(spark, copies):
    first = exchanged(profile._hash_groups(copies))
    assert first and all("_h1" in line and "text" not in line and " b#" not in line for line in first)


def test_stored_sketches(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=20_000), np.full(10_000, 5.0)])
    df = spark.createDataFrame([(i % 9, float(v), None) for i, v in enumerate(x)], "day int, v double, none double")
    stored = quantiles.quantile_sketches(df, ["v", "none"], ["day"])
    assert stored.count() == 18
    shares = [0.01, 0.25, 0.5, 0.9]
    got = {r["column_name"]: r for r in quantiles.merged_quantiles(stored, shares).collect()}
    assert got["v"]["n"] == 30_000 and got["none"]["values"] is None
    for q, v in zip(shares, got["v"]["values"]):
        assert (x < v).mean() - 0.005 <= q <= (x <= v).mean() + 0.005
    per_day = quantiles.merged_quantiles(stored, [0.5], ["day"]).filter("column_name = 'v'")
    assert per_day.count() == 9 and per_day.agg(F.sum("n")).first()[0] == 30_000
    robust = scale.fit_scaler(df, ["v", "none"], "robust_sketch")
    exact = scale.fit_scaler(df.select("v"), ["v"], "robust")
    assert abs(robust.centers["v"] - exact.centers["v"]) < 0.05 and robust.centers["none"] is None and robust.scales["none"] == 1.0


def test_bucketed_series_need_no_shuffle_and_no_sort(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("s"), F.col("id").alias("t"), F.sin("id").alias("v"))
    spark.sql("DROP TABLE IF EXISTS laid_out")
    sinks.write_series(df, "laid_out", ["s"], ["t"], 4)
    table = sinks.read_series(spark, "laid_out")
    try:
        layout = ordering.SeriesLayout(("s",), ("t",), ordering.ROWS_PER_TASK)
        lengths = {"sum": 5, "mean": 5, "max_min": 5, "standard_deviation": 5}
        made = {"roll": lambda d: features.engineer(d, layout, {"mean": ["v"], "maximum": ["v"]}, lengths), "split": lambda d: split.split_rows(d, layout, 0.7),
                "index": lambda d: ordering.dense_index(d, layout)}
        for name, build in made.items():
            plan = build(table)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Sort " not in plan, (name, plan)
            assert build(table).orderBy("s", "t").collect() == build(df).orderBy("s", "t").collect()
        samples = sequence.input_sequences(table, layout, ["v"], 6, 2)
        assert exchanged(samples) == []
        assert samples.orderBy("s", "sample").collect() == sequence.input_sequences(df, layout, ["v"], 6, 2).orderBy("s", "sample").collect()
    finally:
        spark.conf.unset(sinks.SORTED_BUCKETS)
        spark.sql("DROP TABLE laid_out")


@pytest.mark.parametrize("combine", [True, False])
def test_cleaned_rows_combined_or_by_series(spark, tmp_path, combine):
    df = spark.createDataFrame([(s, t, 1.0, float(t * s), None if t == 3 else 2.0 * t) for s in (1, 2) for t in range(6)], "s int, t int, flat double, a double, y double")
    got = lifecycle.write_cleaned(df, Config.from_mapping({"clean": {"target": "y", "combine_files": combine}}), ["s"], f"{tmp_path}/cleaned", ["t"])
    assert got.removed == ("flat",) and got.inputs == ("a",)
    assert (tmp_path / "cleaned" / "s=1").is_dir() != combine
    assert spark.read.parquet(f"{tmp_path}/cleaned").count() == 10
