"""Column selection and engineered features of ordered series."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesml.functions.columns import correlation, is_numeric
from seriesml.functions.rolling import FEATURES, SERIES_FEATURES, rolling_mean, slope
from seriesml.operators.ordering import SeriesLayout, dense_index, over_series, series_stats
from seriesml.operators.peaks import peak_frequency
from seriesml.session import materialise

# Default rolling length, rolling length of the peak frequency, and the reported share of missing values.
ROLLING_LENGTH = 10
PEAK_MEAN_LENGTH = 200
MISSING_SHARE = 0.2


def select_variables(df: DataFrame, include: Sequence[str] | None, targets: Sequence[str] = (),
                     keys: Sequence[str] = ()) -> DataFrame:
    """Targets first, then the wanted variables in table order; an unknown name only warns."""
    wanted = list(df.columns) if include is None else list(include)
    for name in wanted:
        if name not in df.columns:
            warnings.warn(f"variable {name} is not in the table", stacklevel=2)
    inputs = [c for c in df.columns if c in wanted and c not in targets and c not in keys]
    return df.select(*keys, *targets, *inputs)


def numeric_only(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns that are neither numeric nor boolean, except `keep`."""
    keep = set(keep)
    return df.select(*[f.name for f in df.schema
                       if f.name in keep or is_numeric(f.dataType) or isinstance(f.dataType, T.BooleanType)])


def booleans_to_int(df: DataFrame) -> DataFrame:
    """Boolean columns as 0/1."""
    return df.select(*[F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType)
                       else F.col(f.name) for f in df.schema])


def targets_first(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    return df.select(*targets, *[c for c in df.columns if c not in targets])


def check_inputs(df: DataFrame, expected: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Columns of the fitted catalogue in catalogue order; extras are dropped, a missing one is an error."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"input features missing from the table: {', '.join(missing)}")
    return df.select(*keys, *expected)


def engineer(df: DataFrame, layout: SeriesLayout, features: Mapping[str, Sequence[str]],
             lengths: Mapping[str, int] | None = None, peak_mean_length: int = PEAK_MEAN_LENGTH) -> DataFrame:
    """Add `<column>_<feature>` for each feature name and its columns.

    All windowed features are one projection over one ordered window per series. `lengths` sets the rolling length
    by name (`sum`, `mean`, `max_min`, `standard_deviation`).
    """
    lengths = dict(lengths or {})
    unknown = [name for name in features if name not in FEATURES and name not in SERIES_FEATURES]
    if unknown:
        raise ValueError(f"unknown features: {', '.join(unknown)}")

    def length(name: str) -> int:
        return int(lengths.get(FEATURES[name].length, ROLLING_LENGTH)) if FEATURES[name].length else 1

    windowed = [(name, c) for name, cols in features.items() if name in FEATURES for c in cols]
    out, index = df, None
    if layout.sliced:
        # Indexed and written once; every feature below starts from this table.
        out, index = materialise(dense_index(df, layout), "indexed"), "_i"
    rows = out
    if windowed:
        back = max(max(FEATURES[name].back, length(name) - 1) for name, _ in windowed)
        ahead = max(FEATURES[name].ahead for name, _ in windowed)
        out = over_series(
            out, layout,
            lambda w: [FEATURES[n].build(F.col(c), w, length(n)).alias(f"{c}_{n}") for n, c in windowed],
            back, ahead, index)
    spread = {f"{c}_variance": F.var_pop(c) for c in features.get("variance", ())}
    if spread:
        out = series_stats(out, layout, spread)
    for c in features.get("peak_frequency", ()):
        out = peak_frequency(out, layout, c, f"{c}_peak_frequency", peak_mean_length, rows=rows)
    return out.drop("_i") if index else out


def engineer_all(df: DataFrame, layout: SeriesLayout, cols: Sequence[str], lengths: Mapping[str, int] | None = None,
                 peaks: bool = True, peak_mean_length: int = PEAK_MEAN_LENGTH) -> DataFrame:
    """Every feature of every column."""
    names = [*FEATURES, "variance"] + (["peak_frequency"] if peaks else [])
    return engineer(df, layout, {n: list(cols) for n in names}, lengths, peak_mean_length)


def smoothed_slope(df: DataFrame, layout: SeriesLayout, col: str, out: str, n: int = 1,
                   absolute: bool = False) -> DataFrame:
    """Slope angle, optionally its absolute value, and the rolling mean of it over `n` rows."""
    angled = over_series(df, layout, lambda w: [slope(F.col(col), w, absolute=absolute).alias("_angle")], 2)
    if n == 1:
        return angled.withColumnRenamed("_angle", out)
    return over_series(angled, layout, lambda w: [rolling_mean(F.col("_angle"), w, n).alias(out)], n - 1).drop("_angle")


def missing_report(df: DataFrame, cols: Sequence[str], share: float = MISSING_SHARE) -> DataFrame:
    """Share of missing values per column and whether it is above `share`."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return (row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("p_missing"))
                                          for c in cols])))
            .withColumn("too_many", F.col("p_missing") > share))


def target_correlation_filter(df: DataFrame, target: str, inputs: Sequence[str], threshold: float) -> list[str]:
    """Inputs whose absolute Pearson correlation with the target reaches the threshold; 0 keeps all."""
    if threshold <= 0 or not inputs:
        return list(inputs)
    row = df.agg(*[correlation(target, c).alias(c) for c in inputs]).first()
    return [c for c in inputs if row[c] is not None and abs(row[c]) >= threshold]
