"""Class labels: sorted encoding, one-hot targets and decoding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesml.functions.columns import above_half, argmax
from seriesml.operators.ordering import lookup, sorted_positions

# Above this many classes the mapping is joined as a table instead of written into the plan.
INLINE_CLASSES = 2000


@dataclass(frozen=True)
class LabelEncoding:
    """Sorted classes; the code of a class is its position. Very many classes are kept as a table (class, `_code`)."""

    column: str
    classes: tuple = ()
    table: DataFrame | None = None

    @property
    def binary(self) -> bool:
        return self.table is None and len(self.classes) <= 2

    @property
    def size(self) -> int:
        return len(self.classes) if self.table is None else self.table.count()


def fit_labels(df: DataFrame, col: str, inline_classes: int = INLINE_CLASSES) -> LabelEncoding:
    """Classes over all series, NULL left out."""
    classes = df.select(col).filter(F.col(col).isNotNull()).distinct()
    found = [r[0] for r in classes.limit(inline_classes + 1).collect()]
    if len(found) > inline_classes:
        placed = sorted_positions(classes, col, "_code")
        return LabelEncoding(col, table=placed.withColumn("_code", F.col("_code").cast("int")))
    return LabelEncoding(col, tuple(sorted(found)))


def encode_label(df: DataFrame, encoding: LabelEncoding, out: str | None = None) -> DataFrame:
    """Replace labels by codes 0..n-1; a class unseen at fit time becomes NULL."""
    col, out = encoding.column, out or encoding.column
    if encoding.table is not None:
        coded = lookup(df, encoding.table, [col])
        if out == col:
            return coded.select(*[F.col("_code").alias(c) if c == col else F.col(c) for c in df.columns])
        return coded.withColumnRenamed("_code", out)
    at = F.array_position(F.array(*[F.lit(c) for c in encoding.classes]), F.col(col))
    return df.withColumn(out, F.when(at > 0, at - 1).cast("int"))


def one_hot(df: DataFrame, encoding: LabelEncoding, prefix: str = "target") -> DataFrame:
    """Columns `target_0..` in class order instead of the label. Needs more than two classes, and takes any number."""
    if encoding.binary:
        raise ValueError("one-hot encoding needs more than two classes; use a plain label")
    coded, rest = encode_label(df, encoding), [c for c in df.columns if c != encoding.column]
    flags = [F.coalesce((F.col(encoding.column) == i).cast("int"), F.lit(0)).alias(f"{prefix}_{i}") for i in range(encoding.size)]
    return coded.select(*rest, *flags)


def one_hot_array(df: DataFrame, encoding: LabelEncoding, out: str = "target") -> DataFrame:
    """The same flags as one array column, for classes too many to be columns."""
    coded, rest = encode_label(df, encoding), [c for c in df.columns if c != encoding.column]
    code = F.col(encoding.column)
    return coded.select(*rest, F.transform(F.sequence(F.lit(0), F.lit(encoding.size - 1)), lambda i: F.coalesce((i == code).cast("int"), F.lit(0))).alias(out))


def decode(scores: Column | str, classes: int) -> Column:
    """Class of a score array (first largest) or, for a single binary score, of `score > 0.5`."""
    return argmax(scores) if classes > 2 else above_half(scores)

