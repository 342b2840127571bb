"""Cleaning: removable columns from the profile, missing rows, index columns, and the target at inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesml.functions.columns import alert_variable, has_token, nan_to_null, numeric_columns
from seriesml.operators import profile
from seriesml.operators.ordering import SeriesLayout, over_series


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column missing in one of them is NULL there."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop listed columns; absent names are ignored."""
    return df.drop(*names)


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any missing value, NaN included."""
    return nan_to_null(df).na.drop("any", subset=list(cols) if cols else None)


def drop_target(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Inference input may still hold the target."""
    return df.drop(*targets)


def monotonic_columns(df: DataFrame, layout: SeriesLayout, cols: Sequence[str]) -> DataFrame:
    """Whether each column never decreases within any series. A missing value breaks the order."""
    checked = over_series(df.select(*dict.fromkeys([*layout.series, *layout.order, *cols])), layout, lambda w: [
        (F.lag(F.lit(1)).over(w).isNull() | F.coalesce(F.col(c) >= F.lag(c).over(w), F.lit(False))).alias(f"_ok_{c}")
        for c in cols], 1)
    row = checked.agg(*[F.bool_and(F.col(f"_ok_{c}")).alias(c) for c in cols])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("is_monotonic")) for c in cols])))


def drop_index_column(df: DataFrame, layout: SeriesLayout, targets: Sequence[str] = ()) -> DataFrame:
    """Drop the first data column when it is an index (never decreasing in any series). Targets are exempt."""
    first = next((c for c in df.columns if c not in layout.series), None)
    if first is None or first in targets:
        return df
    row = monotonic_columns(df, layout, [first]).first()
    return df.drop(first) if row["is_monotonic"] else df


def removable_columns(df: DataFrame, target: str | None, zeros_threshold: float = 1.0, max_correlation: float = 1.0,
                      method: str = "pearson", absolute: bool = False) -> list[str]:
    """Columns to remove: constant, more zeros than allowed, or too close to an earlier column that stays.

    One profile row and one correlation row reach the driver; both have a fixed number of values per column pair.
    """
    cols = numeric_columns(df)
    flags = {r["column_name"]: r for r in profile.column_flags(df, df.columns).collect()}
    matrix = profile.correlation_lookup(df, cols, method)
    removed: list[str] = []
    for name in df.columns:
        if flags[name]["is_constant"] or (flags[name]["p_zeros"] or 0.0) > zeros_threshold:
            removed.append(name)
    for name in cols:
        if name == target or name in removed:
            continue
        for other in cols:
            score = matrix.get((name, other))
            if other in (name, target) or other in removed or score is None:
                continue
            if (abs(score) if absolute else score) > max_correlation:
                removed.append(other)
    return [c for c in df.columns if c in removed and c != target]


def parse_alerts(alerts: DataFrame, text: str = "alert") -> DataFrame:
    """Variable and kinds of an alert text such as `[x] has 30.0% zeros`."""
    c: Column = F.col(text)
    return alerts.select(
        text, alert_variable(c).alias("variable"),
        has_token(c, "constant").alias("is_constant"), has_token(c, "zeros").alias("is_zeros"),
        has_token(c, "correlated").alias("is_correlated")).filter(F.col("variable").isNotNull())


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
