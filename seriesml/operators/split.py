"""Train / test assignment and seeded sampling. The result is a `split` column, never a physical cut."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesml.operators.ordering import SeriesLayout, dense_index, lookup, series_layout, sorted_positions


def seeded_key(cols: Sequence[str], seed: int) -> Column:
    """A repeatable pseudo-random sort key of a row identity."""
    return F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))


def _tag(position: Column, total: Column, share: float) -> Column:
    return F.when(position < F.floor(total.cast("double") * F.lit(float(share))), "train").otherwise("test")


def split_rows(df: DataFrame, layout: SeriesLayout, share: float) -> DataFrame:
    """The first `int(n * share)` rows of each series are training rows (of the whole table without series columns)."""
    indexed = dense_index(df, layout, "_i", "_n")
    return indexed.withColumn("split", _tag(F.col("_i"), F.col("_n"), share)).drop("_i", "_n")


def split_rows_shuffled(df: DataFrame, series: Sequence[str], ids: Sequence[str], share: float, seed: int) -> DataFrame:
    """As `split_rows`, in a seeded random order instead of the recorded one."""
    keyed = df.withColumn("_key", seeded_key(ids, seed))
    layout = series_layout(keyed, series, ["_key", *ids])
    return split_rows(keyed, layout, share).drop("_key")


def split_series(df: DataFrame, series: str, share: float, shuffle_seed: int | None = None) -> DataFrame:
    """The first `int(k * share)` of the k series, in sorted or in seeded random order, are training series."""
    names = df.select(series).distinct()
    if shuffle_seed is None:
        placed = sorted_positions(names, series, "_i", "_n")
    else:
        keyed = names.withColumn("_key", seeded_key([series], shuffle_seed))
        placed = dense_index(keyed, series_layout(keyed, (), ("_key", series)), "_i", "_n")
    tagged = placed.select(series, _tag(F.col("_i"), F.col("_n"), share).alias("split"))
    return lookup(df, tagged, [series], "inner")


def sample_rows(df: DataFrame, ids: Sequence[str], n: int, seed: int) -> DataFrame:
    """`n` rows chosen by a seeded hash of their identity: repeatable, and independent of partitioning."""
    return df.orderBy(seeded_key(ids, seed), *ids).limit(n)


def shuffle_rows(df: DataFrame, ids: Sequence[str], seed: int) -> DataFrame:
    """Seeded random order."""
    return df.orderBy(seeded_key(ids, seed), *ids)
