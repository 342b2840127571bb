"""Scaling: parameters fitted on the training rows only, applied as literals to all rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesml.operators.quantiles import DIRECT_ROWS, exact_quantiles, sketched_quantiles


@dataclass(frozen=True)
class Scaler:
    """Centre and divisor per column."""

    method: str
    centers: dict[str, float]
    scales: dict[str, float]


def _divisor(spread: float | None) -> float:
    return 1.0 if not spread else float(spread)


def _fit_standard(train: DataFrame, cols: Sequence[str], direct_rows: int) -> Scaler:
    row = train.agg(*[F.avg(c).alias(f"{c}_0") for c in cols], *[F.stddev_pop(c).alias(f"{c}_1") for c in cols]).first()
    return Scaler("standard", {c: row[f"{c}_0"] for c in cols}, {c: _divisor(row[f"{c}_1"]) for c in cols})


def _fit_minmax(train: DataFrame, cols: Sequence[str], direct_rows: int) -> Scaler:
    row = train.agg(*[F.min(c).cast("double").alias(f"{c}_0") for c in cols],
                    *[F.max(c).cast("double").alias(f"{c}_1") for c in cols]).first()
    spread = {c: (row[f"{c}_1"] - row[f"{c}_0"]) if row[f"{c}_0"] is not None else None for c in cols}
    return Scaler("minmax", {c: row[f"{c}_0"] for c in cols}, {c: _divisor(spread[c]) for c in cols})


def _fit_robust(train: DataFrame, cols: Sequence[str], direct_rows: int) -> Scaler:
    found = exact_quantiles(train, cols, [0.25, 0.5, 0.75], direct_rows)
    spread = {c: (q[2] - q[0]) if q[0] is not None else None for c, q in found.items()}
    return Scaler("robust", {c: found[c][1] for c in cols}, {c: _divisor(spread[c]) for c in cols})


def _fit_robust_sketch(train: DataFrame, cols: Sequence[str], direct_rows: int) -> Scaler:
    """Robust scaling from sketched quantiles: one pass, ranks off by a fraction of a percent."""
    found = sketched_quantiles(train, cols, [0.25, 0.5, 0.75])
    spread = {c: (q[2] - q[0]) if q[0] is not None else None for c, q in found.items()}
    return Scaler("robust", {c: found[c][1] for c in cols}, {c: _divisor(spread[c]) for c in cols})


def _fit_none(train: DataFrame, cols: Sequence[str], direct_rows: int) -> Scaler:
    return Scaler("none", {}, {})


SCALERS: dict[str | None, Callable[[DataFrame, Sequence[str], int], Scaler]] = {
    "standard": _fit_standard, "minmax": _fit_minmax, "robust": _fit_robust, "robust_sketch": _fit_robust_sketch, "none": _fit_none, None: _fit_none,
}


def fit_scaler(train: DataFrame, cols: Sequence[str], method: str | None, direct_rows: int = DIRECT_ROWS) -> Scaler:
    """Fit on the rows given; pass only the training rows. The result has two numbers per column."""
    if method not in SCALERS:
        raise ValueError(f"unknown scaling method {method}")
    return SCALERS[method](train, cols, direct_rows)


def fit_target_scaler(train: DataFrame, targets: Sequence[str], method: str | None, classification: bool) -> Scaler:
    """Targets are scaled for regression only."""
    return fit_scaler(train, targets, None if classification else method)


def scaled(scaler: Scaler, name: str) -> Column:
    if name not in scaler.centers:
        return F.col(name)
    center = scaler.centers[name]
    return (F.col(name) - F.lit(None if center is None else float(center)).cast("double")) / F.lit(scaler.scales[name])


def unscaled(scaler: Scaler, name: str, value: Column | None = None) -> Column:
    value = F.col(name) if value is None else value
    if name not in scaler.centers:
        return value
    center = scaler.centers[name]
    return value * F.lit(scaler.scales[name]) + F.lit(None if center is None else float(center)).cast("double")


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.select(*[scaled(scaler, c).alias(c) for c in df.columns])


def invert_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.select(*[unscaled(scaler, c).alias(c) for c in df.columns])
