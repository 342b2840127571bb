"""Model registry: an append-only table of fitted models."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("model_id string, params string, metrics map<string,double>, "
          "importances array<struct<feature:string,importance:double>>")
PARAMS = ("profile struct<dataset:string>, clean struct<target:string,classification:boolean>, "
          "train struct<learning_method:string>, sequentialize struct<window_size:int>")
TOP_IMPORTANCES = 10


def register_model(spark: SparkSession, path: str, model_id: str, params: Mapping, metrics: Mapping[str, float],
                   importances: Sequence[tuple[str, float]] = ()) -> None:
    """Append one model with its ten largest importances."""
    top = sorted(importances, key=lambda p: (-p[1], p[0]))[:TOP_IMPORTANCES]
    row = (model_id, json.dumps(params), {k: float(v) for k, v in metrics.items()}, [(n, float(v)) for n, v in top])
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def find_model(registry: DataFrame, model_id: str) -> DataFrame:
    return registry.filter(F.col("model_id") == model_id)


def overview(registry: DataFrame) -> DataFrame:
    """One row per model and metric with the main settings from its parameters, and its most important feature."""
    parsed = registry.withColumn("p", F.from_json("params", PARAMS))
    best = F.array_max(F.transform("importances", lambda i: F.struct(i["importance"], i["feature"])))
    return parsed.select(
        "model_id", F.col("p.profile.dataset").alias("dataset"), F.col("p.clean.target").alias("target"),
        F.col("p.train.learning_method").alias("method"), F.col("p.sequentialize.window_size").alias("window_size"),
        best["feature"].alias("top_feature"), F.explode("metrics").alias("metric", "score"))
