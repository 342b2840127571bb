"""Per-series feature expressions over an ordered window.

Every function takes the value column and the ordered window of its series and returns one expression, so all
features of a table share one sort. Rolling features look back over `n` rows and are NULL until `n` values exist.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Sampling step in seconds and shift in rows of the slope, and the scale of the peak frequency.
SLOPE_STEP = 0.1
SLOPE_SHIFT = 2
PEAK_SCALE = 10.0


def _full(agg: Callable[[Column], Column]) -> Callable[[Column, WindowSpec, int], Column]:
    def build(c: Column, w: WindowSpec, n: int) -> Column:
        frame = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count(c).over(frame) == n, agg(c).over(frame))
    return build


rolling_sum = _full(F.sum)
rolling_mean = _full(F.avg)
rolling_max = _full(F.max)
rolling_min = _full(F.min)
rolling_std = _full(F.stddev_samp)


def rolling_range(c: Column, w: WindowSpec, n: int) -> Column:
    return rolling_max(c, w, n) - rolling_min(c, w, n)


def gradient(c: Column, w: WindowSpec, n: int = 1) -> Column:
    """Central difference inside the series, one-sided difference at its two ends."""
    back, ahead = F.lag(c).over(w), F.lead(c).over(w)
    has_back, has_ahead = F.lag(F.lit(1)).over(w).isNotNull(), F.lead(F.lit(1)).over(w).isNotNull()
    return (F.when(has_back & has_ahead, (ahead - back) / 2.0)
            .when(has_ahead, ahead - c)
            .when(has_back, c - back))


def slope(c: Column, w: WindowSpec, n: int = 1, absolute: bool = False, shift: int = SLOPE_SHIFT) -> Column:
    """Angle of the rise over `shift` rows; with n > 1 its rolling mean has to be taken in a second step."""
    angle = F.atan((c - F.lag(c, shift).over(w)) / F.lit(SLOPE_STEP * shift))
    return F.abs(angle) if absolute else angle


def slope_sin(c: Column, w: WindowSpec, n: int = 1) -> Column:
    return F.sin(slope(c, w))


def slope_cos(c: Column, w: WindowSpec, n: int = 1) -> Column:
    return F.cos(slope(c, w))


@dataclass(frozen=True)
class Feature:
    """A windowed feature: its expression, the configuration field of its length, and the rows it looks at."""

    build: Callable[[Column, WindowSpec, int], Column]
    length: str | None = None
    back: int = 0
    ahead: int = 0


# Suffix of the engineered column -> feature. `variance` and `peak_frequency` are built from whole series elsewhere.
FEATURES: dict[str, Feature] = {
    "sum": Feature(rolling_sum, "sum"),
    "gradient": Feature(gradient, None, 1, 1),
    "mean": Feature(rolling_mean, "mean"),
    "maximum": Feature(rolling_max, "max_min"),
    "minimum": Feature(rolling_min, "max_min"),
    "min_max_range": Feature(rolling_range, "max_min"),
    "slope": Feature(slope, None, SLOPE_SHIFT),
    "slope_sin": Feature(slope_sin, None, SLOPE_SHIFT),
    "slope_cos": Feature(slope_cos, None, SLOPE_SHIFT),
    "standard_deviation": Feature(rolling_std, "standard_deviation"),
}
SERIES_FEATURES = ("variance", "peak_frequency")
