"""Registered queries: a function (spark, folder) -> DataFrame and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# events with the numeric property k and the derived columns for missing values, zeros, constants and near copies.
EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, k,
         CASE WHEN k % 7 = 0 THEN NULL ELSE value END AS value_n,
         CASE WHEN k % 5 = 0 THEN 0.0 ELSE value END AS value_z,
         CAST(1.0 AS DOUBLE) AS const, 2 * value AS value_dup
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def query(name: str, sql: str | None = None):
    """Register a query; `{ev}` in the SQL stands for the events view."""
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.replace("{ev}", EV).strip()
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ev(spark: SparkSession, folder: str) -> DataFrame:
    """The events view of the SQL side."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (table(spark, folder, "events")
            .select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
            .withColumn("value_n", F.when(F.col("k") % 7 != 0, F.col("value")))
            .withColumn("value_z", F.when(F.col("k") % 5 == 0, F.lit(0.0)).otherwise(F.col("value")))
            .withColumn("const", F.lit(1.0)).withColumn("value_dup", 2 * F.col("value")))


def long(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")
