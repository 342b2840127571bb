"""Tables and catalogues written between stages."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from seriesml.config import Clean
from seriesml.operators.scale import Scaler

# Files of a bucket are sorted as the table says; holds for tables whose buckets have one file each.
SORTED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@dataclass(frozen=True)
class FeatureCatalogue:
    """Ordered target and input names, and the columns cleaning removed."""

    targets: tuple[str, ...]
    inputs: tuple[str, ...]
    removed: tuple[str, ...] = ()


def write_table(df: DataFrame, path: str, series: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """One combined table, or one folder per series when `series` is given."""
    writer = df.write.mode(mode)
    if series:
        writer = writer.partitionBy(*series)
    writer.parquet(path)


def write_series(df: DataFrame, table: str, series: Sequence[str], order: Sequence[str], buckets: int) -> None:
    """A table in the warehouse whose buckets hold whole series in order, one file each.

    Rolling features, splits and samples of it need no shuffle, and, with `SORTED_BUCKETS` set, no sort. A series of many rows
    makes its bucket large: choose buckets for series that fit a task.
    """
    laid = df.repartition(buckets, *series).sortWithinPartitions(*series, *order)
    laid.write.mode("overwrite").bucketBy(buckets, *series).sortBy(*series, *order).format("parquet").saveAsTable(table)


def read_series(spark: SparkSession, table: str) -> DataFrame:
    """A table of `write_series`; from now on the session takes the order of bucket files as given."""
    spark.conf.set(SORTED_BUCKETS, "true")
    return spark.table(table)


def write_cleaned(df: DataFrame, path: str, clean: Clean, series: Sequence[str]) -> None:
    """The cleaned rows as one combined table, or one folder per series when the configuration does not combine files."""
    write_table(df, path, None if clean.combine_files else series)


def write_json(df: DataFrame, path: str) -> None:
    """Predictions, metrics and reports as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def _save_object(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _load_object(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def save_catalogue(spark: SparkSession, catalogue: FeatureCatalogue, path: str) -> None:
    _save_object(spark, asdict(catalogue), path)


def load_catalogue(spark: SparkSession, path: str) -> FeatureCatalogue:
    return FeatureCatalogue(**{k: tuple(v) for k, v in _load_object(spark, path).items()})


def save_scaler(spark: SparkSession, scaler: Scaler, path: str) -> None:
    _save_object(spark, asdict(scaler), path)


def load_scaler(spark: SparkSession, path: str) -> Scaler:
    return Scaler(**_load_object(spark, path))


def model_path(root: str, model_id: str, method: str) -> str:
    return f"{root.rstrip('/')}/{model_id}/model_{method}"


def save_model(model: PipelineModel, root: str, model_id: str, method: str) -> str:
    path = model_path(root, model_id, method)
    model.write().overwrite().save(path)
    return path


def load_model(root: str, model_id: str, method: str) -> PipelineModel:
    return PipelineModel.load(model_path(root, model_id, method))
