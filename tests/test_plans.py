"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from seriesml.operators import clean, encode, features, profile, scale, sequence, split
from seriesml.operators.ordering import lookup, series_layout
from seriesml.plans.catalogue import QUERIES
from seriesml.plans.registry import ev, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single|Round)", plan(df)))


def layout(df):
    return series_layout(df, ["user_id"], ["ts", "event_id"])


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("train_", "tune_", "stream_", "bootstrap"))))
def test_no_cross_join(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_all_features_share_one_shuffle_and_sort(spark, data):
    df = ev(spark, data).select("user_id", "ts", "event_id", "value", "k")
    made = features.engineer_all(df, layout(df), ["value", "k"], peaks=False)
    assert shuffles(made) == 1
    assert plan(made).count("Sort [") == 1


def test_split_samples_and_windows_reuse_the_partitioning(spark, data):
    df = ev(spark, data).select("user_id", "ts", "event_id", "value")
    assert shuffles(split.split_rows(df, layout(df), 0.7)) == 1
    assert shuffles(sequence.sequences(df, layout(df), ["value"], ["value"], 10, overlap=3)) == 1
    both = features.engineer(split.split_rows(df, layout(df), 0.7), layout(df), {"mean": ["value"]})
    assert shuffles(both) == 1


def test_row_operators_do_not_shuffle_and_prune(spark, data):
    df = table(spark, data, "events")
    encoded = encode.encode_label(df.select("event_id", "event_type"), encode.fit_labels(df, "event_type"), "c")
    scaled = scale.apply_scaler(df.select("event_id", "value"), scale.fit_scaler(df, ["value"], "standard"))
    for made in (encoded, scaled, clean.drop_missing(df.select("value"))):
        assert shuffles(made) == 0
        assert "props" not in re.search(r"ReadSchema: (.*)", made._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))).group(1)


def test_filters_reach_the_scan(spark, data):
    made = clean.drop_missing(table(spark, data, "orders").filter(F.col("o_totalprice") > 1000).select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in plan(made)


def test_small_lookup_is_broadcast_and_large_is_not(spark, data, monkeypatch):
    df = table(spark, data, "events")
    tags = df.groupBy("user_id").agg(F.count("*").alias("n"))
    assert "BroadcastHashJoin" in plan(lookup(df, tags, ["user_id"]))
    monkeypatch.setattr("seriesml.operators.ordering.BROADCAST_ROWS", 3)
    assert "rows broadcast" not in plan(lookup(df, tags, ["user_id"]))
    assert "ResolvedHint" not in lookup(df, tags, ["user_id"])._jdf.queryExecution().analyzed().toString()


def test_many_columns_correlate_through_one_matrix(spark):
    df = spark.range(500).select(*[F.sin(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(14)], F.lit(1.0).alias("one"))
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in profile.pearson(df).collect()}
    want = df.toPandas().corr()
    assert len(got) == 15 * 14 // 2
    assert all(abs(got[f"c{i}", f"c{j}"] - want.iloc[i, j]) < 1e-9 for i in range(14) for j in range(i + 1, 14))
    assert got["c0", "one"] is None


def test_many_columns_with_gaps_take_one_more_pass(spark):
    gap = [F.when((F.col("id") + i) % (i + 3) != 0, F.sin(F.col("id") * (i + 1)) * (i + 1)).alias(f"c{i}") for i in range(12)]
    df = spark.range(400).select(*gap, F.cos("id").alias("full"), F.tan("id").alias("also"))
    made = profile.pearson(df)
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in made.collect()}
    want = df.toPandas().corr()
    assert len(got) == 14 * 13 // 2
    assert all(abs(v - want.loc[a, b]) < 1e-9 for (a, b), v in got.items())
    assert plan(profile.pearson(df)).count("Range (") <= 2


def test_uniform_columns_share_one_aggregate(spark, data):
    df = table(spark, data, "orders")
    got = {r["column_name"]: r for r in profile.uniform_columns(df, ["o_orderstatus", "o_orderpriority"]).collect()}
    for c in ("o_orderstatus", "o_orderpriority"):
        alone = profile.uniformity(df, c).first()
        assert got[c]["n_distinct"] == alone["n_distinct"] and abs(got[c]["chi_squared"] - alone["chi_squared"]) < 1e-6
