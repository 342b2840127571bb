"""Stream sources and bounded runs into tables."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seriesml.operators import learners
from seriesml.session import scratch_path


def read_files(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
               files_per_trigger: int = 100) -> DataFrame:
    """New parquet files of a folder as a stream, a bounded number of files per micro-batch."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", files_per_trigger).parquet(folder))


def score_stream(stream: DataFrame, model: Model, features: str | list[str], out: str = "y_pred") -> DataFrame:
    """Predictions of a fitted model: row by row, without state."""
    return learners.predict(learners.with_vector(stream, features), model, out).drop("features")


def run_available(stream: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process what is there now into a parquet table and read it back."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)
    checkpoint = checkpoint or scratch_path(spark, f"{name}-progress")
    run = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
           .outputMode("append").trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
