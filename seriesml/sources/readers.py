"""Scans of data set folders and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesml.functions.columns import nan_to_null
from seriesml.operators.clean import union_by_name

SERIES = "series_id"
ORDER = "ord"


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the `.csv` files of a folder in name order, from any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(folder)
    files = [s.getPath() for s in fs.listStatus(path) if s.isFile()]
    return [p.toString() for p in sorted(files, key=lambda p: p.getName()) if p.getName().endswith(".csv")]


def read_csv_folder(spark: SparkSession, folder: str, schema: T.StructType | str | None = None,
                    order: Sequence[str] | None = None) -> DataFrame:
    """All CSV files of a folder as one table; `series_id` is the file name.

    With a `schema` all files are one scan. Without one, files are read by name and aligned, as columns may differ.
    `ord` gives the row order: taken from `order` columns, or else from the position in the file. Files without
    data rows contribute nothing; a malformed row stops the job.
    """
    files = list_csv(spark, folder)
    if not files:
        raise FileNotFoundError(f"no .csv files in {folder}")
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    if schema is not None:
        table = _tag(reader.schema(schema).csv(files), order)
    else:
        frames = [reader.option("inferSchema", True).csv(f) for f in files]
        frames = [_tag(f, order) for f in frames if f.columns]
        if not frames:
            raise ValueError(f"all .csv files in {folder} are empty")
        table = union_by_name(frames)
    return nan_to_null(table)


def _tag(df: DataFrame, order: Sequence[str] | None) -> DataFrame:
    data = df.columns
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    if order:
        return df.select(name.alias(SERIES), *data)
    # Partitions follow the blocks of a file, so block start and position in the partition give the file order.
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return df.select(name.alias(SERIES), (place["block"]).alias("ord_block"), place["at"].alias(ORDER), *data)


def read_emissions_log(spark: SparkSession, path: str) -> DataFrame:
    """An emissions log with parsed timestamps."""
    numeric = ", ".join(f"{c} double" for c in (
        "duration", "emissions", "energy_consumed", "cpu_energy", "ram_energy", "emissions_rate"))
    raw = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).schema(
        f"timestamp string, project_name string, {numeric}").csv(path)
    return raw.withColumn("timestamp", F.to_timestamp("timestamp"))
