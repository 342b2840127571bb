"""Columnar JSON payloads of the inference interface."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUEST = ("struct<param:struct<modeluid:string>,"
           "scalar:struct<headers:array<string>,data:array<array<string>>>>")
INDEX = "date"


def decode_requests(df: DataFrame, payload: str, inputs: list[str]) -> DataFrame:
    """One row per data row of each payload: `modeluid`, `row`, the index and the named numeric inputs."""
    parsed = df.select(F.from_json(F.col(payload), REQUEST).alias("p"))
    rows = parsed.select(F.col("p.param.modeluid").alias("modeluid"), F.col("p.scalar.headers").alias("_headers"),
                         F.posexplode("p.scalar.data").alias("row", "_data"))
    cells = F.map_from_arrays("_headers", "_data")
    named = rows.withColumn("_cells", cells)
    return named.select("modeluid", "row", F.try_element_at("_cells", F.lit(INDEX)).alias(INDEX),
                        *[F.try_element_at("_cells", F.lit(c)).cast("double").alias(c) for c in inputs])


def encode_responses(df: DataFrame, modeluid: str, index: str, pred: str, target: str, part_rows: int | None = None) -> DataFrame:
    """JSON answers `[[i, y], …]` per model, as one text each.

    With `part_rows` the answers are split into parts of that many rows, in order; one text has to fit one task, so the
    caller of very long answers sets it.
    """
    part = F.lit(0).cast("long") if part_rows is None else F.floor(F.col(index) / part_rows)
    grouped = df.groupBy(modeluid, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.array(F.col(index).cast("double"), F.col(pred).cast("double")))).alias("data"))
    body = F.to_json(F.struct(
        F.struct(F.col(modeluid).cast("string").alias("modeluid")).alias("param"),
        F.struct(F.array(F.lit(INDEX), F.lit(target)).alias("headers"), F.col("data")).alias("scalar")))
    return grouped.select(F.col(modeluid), "part", body.alias("response"))
