"""Analytics over an emissions log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGE = "project_name"
# Numeric columns of the log.
LOG_COLUMNS = ("duration", "emissions", "energy_consumed", "cpu_energy", "ram_energy", "emissions_rate")


def parse_log(df: DataFrame) -> DataFrame:
    """Timestamps parsed, the duration in minutes instead of seconds."""
    parsed = df if dict(df.dtypes)["timestamp"].startswith("timestamp") else df.withColumn(
        "timestamp", F.to_timestamp("timestamp"))
    return parsed.withColumn("duration", F.col("duration") / 60)


def _numeric(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols else [c for c in LOG_COLUMNS if c in df.columns]


def stage_totals(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.groupBy(STAGE).agg(*[F.sum(c).alias(c) for c in _numeric(df, cols)])


def stage_means(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.groupBy(STAGE).agg(*[F.avg(c).alias(c) for c in _numeric(df, cols)])


def stage_deviations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.groupBy(STAGE).agg(*[F.stddev_samp(c).alias(c) for c in _numeric(df, cols)])


def full_run(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A run of all stages: sum of the stage means, and the root of the summed stage variances as `<column>_std`."""
    cols = _numeric(df, cols)
    stages = df.groupBy(STAGE).agg(*[F.avg(c).alias(f"{c}_m") for c in cols], *[F.var_samp(c).alias(f"{c}_v") for c in cols])
    return stages.agg(*[F.sum(f"{c}_m").alias(c) for c in cols],
                      *[F.sqrt(F.sum(f"{c}_v")).alias(f"{c}_std") for c in cols])


def per_call(df: DataFrame, calls: int, cols: Sequence[str] | None = None) -> DataFrame:
    """Average counters per call of a stage that was repeated `calls` times under one measurement."""
    return df.groupBy(STAGE).agg(*[(F.sum(c) / calls).alias(c) for c in _numeric(df, cols)])


def over_time(df: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Emissions in time order."""
    return df.select(*order, "emissions").orderBy(*order)
