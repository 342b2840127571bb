"""Small column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def numeric_columns(df: DataFrame, booleans: bool = False) -> list[str]:
    """Names of the numeric columns in schema order."""
    return [f.name for f in df.schema
            if is_numeric(f.dataType) or (booleans and isinstance(f.dataType, T.BooleanType))]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Read NaN as missing, so that NULL is the only missing value afterwards."""
    return df.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema
    ])


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded value without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def correlation(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation of the complete pairs; NULL when one side does not vary."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def safe_divisor(c: Column) -> Column:
    """A spread used as a divisor: 1 where it is 0."""
    return F.when(c == 0, F.lit(1.0)).otherwise(c)


def fixed_decimals(c: Column | str, digits: int = 3) -> Column:
    """Number as text with a fixed number of decimals and no grouping."""
    return F.format_string(f"%.{digits}f", c)


def argmax(c: Column | str) -> Column:
    """0-based index of the first largest element of an array."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def above_half(c: Column | str) -> Column:
    """0/1 class of a binary score."""
    c = F.col(c) if isinstance(c, str) else c
    return (c > 0.5).cast("int")


def method_suffix(c: Column | str) -> Column:
    """Method name of a model label: file extension stripped, then the text after the last underscore."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring_index(F.regexp_replace(c, r"\.[^.]*$", ""), "_", -1)


def alert_variable(c: Column | str) -> Column:
    """Variable name between the first pair of brackets of an alert text; NULL when there is none."""
    c = F.col(c) if isinstance(c, str) else c
    found = F.regexp_extract(c, r"\[([^\]]+)\]", 1)
    return F.when(found != "", found)


def has_token(c: Column | str, token: str) -> Column:
    """Whether a blank-separated text has `token` as one of its words."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_contains(F.split(c, r"\s+"), token)


def dot(weights: dict[str, float], bias: float = 0.0) -> Column:
    """Linear score of columns with fixed weights."""
    total = F.lit(float(bias))
    for name, weight in weights.items():
        total = total + F.col(name) * F.lit(float(weight))
    return total
