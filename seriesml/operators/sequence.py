"""Windowed samples: arrays of consecutive rows of a series, with the target inside or after the window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesml.operators.ordering import SeriesLayout, dense_index


def effective_target_size(target_size: int, classification: bool) -> int:
    """Classification always predicts one value per sample."""
    return 1 if classification else target_size


def stride_of(window: int, overlap: int) -> int:
    """Rows between window starts; an overlap of the whole window or more means one row."""
    return window - (window - 1 if overlap >= window else overlap)


def _samples(df: DataFrame, layout: SeriesLayout, window: int, stride: int, ahead: int, row: Column) -> DataFrame:
    """One row per complete window: series, `sample` number, and `_rows`, the `window + ahead` rows it needs.

    A row joins every window that covers it, so groups never exceed the window length, however long the series.
    """
    span = window + ahead
    i = F.col("_i")
    indexed = dense_index(df, layout).select(*layout.series, "_i", row.alias("_row"))
    last = F.floor(i / stride)
    if stride == span:
        spread = indexed.withColumn("sample", last)
    else:
        first = F.greatest(F.lit(0).cast("long"), F.ceil((i - span + 1) / stride))
        spread = (indexed.filter(first <= last)
                  .withColumn("sample", F.explode(F.sequence(first, last))))
    grouped = spread.groupBy(*layout.series, "sample").agg(
        F.array_sort(F.collect_list(F.struct("_i", "_row"))).alias("_rows"))
    return (grouped.filter(F.size("_rows") == span)
            .withColumn("_rows", F.transform("_rows", lambda r: r["_row"])))


def _features(inputs: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in inputs])


def sequences(df: DataFrame, layout: SeriesLayout, inputs: Sequence[str], targets: Sequence[str], window: int,
              target_size: int = 1, overlap: int = 0, future: bool = False) -> DataFrame:
    """Samples with `x` (window x features) and `y` (target_size x targets, row-major).

    `y` holds the last `target_size` rows of the window, or with `future` the rows right after it; a sample whose
    future rows would lie beyond the end of the series is dropped.
    """
    if not future and target_size > window:
        raise ValueError("target_size is larger than the window")
    row = F.struct(_features(inputs).alias("x"), _features(targets).alias("y"))
    ahead = target_size if future else 0
    got = _samples(df, layout, window, stride_of(window, overlap), ahead, row)
    rows = F.col("_rows")
    y = F.flatten(F.transform(F.slice(rows, -target_size, target_size), lambda r: r["y"]))
    x = F.transform(F.slice(rows, 1, window), lambda r: r["x"])
    return got.select(*layout.series, "sample", x.alias("x"), y.alias("y"))


def input_sequences(df: DataFrame, layout: SeriesLayout, inputs: Sequence[str], window: int,
                    overlap: int = 0) -> DataFrame:
    """Samples with `x` only."""
    got = _samples(df, layout, window, stride_of(window, overlap), 0, _features(inputs))
    return got.select(*layout.series, "sample", F.col("_rows").alias("x"))


def flatten_samples(df: DataFrame, col: str = "x") -> DataFrame:
    """Replace the two-dimensional sample by one array in time order: all features of step 0, then of step 1, …"""
    return df.withColumn(col, F.flatten(col))


def flat_names(inputs: Sequence[str], window: int) -> list[str]:
    """Feature names of a flattened sample."""
    if window == 1:
        return list(inputs)
    return [f"{c}_{t}" for t in range(window) for c in inputs]


def sample_counts(samples: DataFrame, series: Sequence[str], split: str = "split") -> DataFrame:
    """Samples per series and split; combining the series is a property of the table, so nothing else has to be done."""
    return samples.groupBy(split, *series).agg(F.count(F.lit(1)).alias("n_samples"))
