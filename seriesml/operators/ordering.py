"""Row order as data: dense positions, trailing and leading windows, and carried values per series.

A series normally fits one task, and a plain window over it is the best plan. A series with more rows than
`rows_per_task` is cut by value ranges of its first order column where that spreads the rows (a timestamp or sequence
number), and by ranges of the whole order tuple where it does not: text, steps below a second, many rows with one and the
same first value. So no task holds more than a slice of a series. The order must be total within a series.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesml.session import materialise

ROWS_PER_TASK = 5_000_000
ROWS_PER_TASK_CONF = "spark.seriesml.rowsPerTask"
INLINE_HOT_SERIES = 1000
# Rows up to which a lookup table is broadcast: a key and a few numbers each.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class SeriesLayout:
    """How the series of one DataFrame are spread over tasks."""

    series: tuple[str, ...]
    order: tuple[str, ...]
    rows_per_task: int
    splits: tuple[float, ...] = ()
    # Order tuples as text, and the types of the order columns: the slices where the first column alone does not cut.
    bounds: tuple[tuple[str | None, ...], ...] = ()
    kinds: tuple[str, ...] = ()
    hot_ids: tuple | None = None
    hot_table: DataFrame | None = None
    hot_rows: int = 0

    @property
    def sliced(self) -> bool:
        return bool(self.splits or self.bounds)


def position_value(df: DataFrame, name: str) -> Column:
    """The order column as a double that never decreases when the column increases."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.TimestampType):
        return c.cast("double")
    if isinstance(kind, T.TimestampNTZType):
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date"))
        return (days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("double")
    if isinstance(kind, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    raise TypeError(f"the first order column {name} must be numeric, a date or a timestamp, not {kind.simpleString()}")


def series_layout(
    df: DataFrame, series: Sequence[str], order: Sequence[str], rows_per_task: int | None = None
) -> SeriesLayout:
    """Count rows per series (one map-side combined aggregate over the key columns) and cut those above the limit."""
    series, order = tuple(series), tuple(order)
    limit = rows_per_task or int(df.sparkSession.conf.get(ROWS_PER_TASK_CONF, str(ROWS_PER_TASK)))
    if not series:
        total = df.count()
        if total <= limit:
            return SeriesLayout(series, order, limit)
        return _cut(df, SeriesLayout(series, order, limit), total)
    counts = df.groupBy(*series).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > limit)
    sizes = hot.agg(F.count(F.lit(1)).alias("n"), F.sum("_n").alias("rows")).first()
    if not sizes["n"]:
        return SeriesLayout(series, order, limit)
    hot = hot.select(*series)
    if len(series) == 1 and sizes["n"] <= INLINE_HOT_SERIES:
        ids = tuple(r[0] for r in hot.collect())
        layout = SeriesLayout(series, order, limit, hot_ids=ids)
    else:
        layout = SeriesLayout(series, order, limit, hot_table=hot, hot_rows=sizes["n"])
    return _cut(_mark_hot(df, layout).filter("_hot"), layout, sizes["rows"])


# Slices of an order tuple at most, and sampled rows for each.
MAX_BOUNDS, ROWS_PER_BOUND = 4096, 50


def _cut(rows: DataFrame, layout: SeriesLayout, total: int) -> SeriesLayout:
    """The layout with its slices: by the first order column if no slice is then above twice the limit, else by the whole order."""
    limit, name = layout.rows_per_task, layout.order[0]
    if isinstance(rows.schema[name].dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)):
        by_value = replace(layout, splits=_splits(rows, name, total, limit))
        if len(layout.order) == 1 and not isinstance(rows.schema[name].dataType, T.TimestampNTZType):
            return by_value  # distinct values spread
        cut = _bucketed(rows, by_value).groupBy(*layout.series, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        if cut.agg(F.max("_n")).first()[0] <= 2 * limit:
            return by_value
    return replace(layout, bounds=_bounds(rows, layout.order, total, limit), kinds=tuple(dict(rows.dtypes)[c] for c in layout.order))


def _bounds(rows: DataFrame, order: Sequence[str], total: int, limit: int) -> tuple[tuple[str | None, ...], ...]:
    """Order tuples that cut the rows evenly, from a sorted sample; as text, which gives back every value exactly."""
    parts = min(MAX_BOUNDS, max(2, math.ceil(total / limit) * 2))
    sample = rows.select(*order).sample(min(1.0, parts * ROWS_PER_BOUND / total), 7) if total > parts * ROWS_PER_BOUND else rows.select(*order)
    found = [tuple(r) for r in sample.orderBy(*order).select(*[F.col(c).cast("string") for c in order]).collect()]
    return tuple(dict.fromkeys(found[len(found) * i // parts] for i in range(1, parts))) if found else ((None,) * len(order),)


def _splits(df: DataFrame, name: str, rows: int, limit: int) -> tuple[float, ...]:
    parts = max(2, math.ceil(rows / limit) * 2)
    cuts = df.agg(
        F.percentile_approx(position_value(df, name), [i / parts for i in range(1, parts)],
                            max(10000, parts * 10)).alias("cuts")
    ).first()["cuts"]
    return tuple(sorted(set(cuts or ()))) or (0.0,)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi join that keeps the left key columns; the side to broadcast is left to runtime statistics."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", rows: int | None = None) -> DataFrame:
    """Join a table that is often small. Its rows are counted up to a limit first (or given): within the limit it is
    broadcast and the left side is not shuffled, which also settles a hot key; beyond it, this is a normal join."""
    if rows is None:
        rows = right.limit(BROADCAST_ROWS + 1).count()
    return join_on(left, F.broadcast(right) if rows <= BROADCAST_ROWS else right, keys, how)


def _mark_hot(df: DataFrame, layout: SeriesLayout) -> DataFrame:
    if not layout.series:
        return df.withColumn("_hot", F.lit(True))
    if layout.hot_ids is not None:
        key = F.col(layout.series[0])
        known = [i for i in layout.hot_ids if i is not None]
        flag = F.coalesce(key.isin(known), F.lit(False)) if known else F.lit(False)
        if len(known) < len(layout.hot_ids):
            flag = flag | key.isNull()
        return df.withColumn("_hot", flag)
    marked = lookup(df, layout.hot_table.withColumn("_hot", F.lit(True)), layout.series, rows=layout.hot_rows)
    return marked.withColumn("_hot", F.coalesce("_hot", F.lit(False)))


def _bucketed(df: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Add `_slice`: the value range of each row."""
    if layout.bounds:
        return df.withColumn("_slice", _tuple_range(layout))
    cutter = Bucketizer(splits=[-math.inf, *layout.splits, math.inf], inputCol="_pos", outputCol="_slice", handleInvalid="keep")
    return cutter.transform(df.withColumn("_pos", position_value(df, layout.order[0]))).withColumn("_slice", F.col("_slice").cast("long")).drop("_pos")


def _tuple_range(layout: SeriesLayout) -> Column:
    """How many bounds are at or before a row's order; many bounds are searched in two steps."""
    row = F.struct(*[F.col(c) for c in layout.order])

    def literal(bound) -> Column:
        return F.struct(*[F.lit(v).cast(k).alias(c) for v, k, c in zip(bound, layout.kinds, layout.order)])

    def before(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= row)).cast("long")
    width = math.isqrt(len(layout.bounds)) if len(layout.bounds) > 64 else len(layout.bounds)
    groups = [F.array(*map(literal, layout.bounds[a:a + width])) for a in range(0, len(layout.bounds), width)]
    if len(groups) == 1:
        return before(groups[0])
    first = before(F.array(*[literal(layout.bounds[a]) for a in range(0, len(layout.bounds), width)]))
    within = before(F.get(F.array(*groups), (first - 1).cast("int")))
    return F.when(first == 0, first).otherwise((first - 1) * width + within)


def _sliced(df: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Add `_slice`: the range of a row of a long series, 0 for all others."""
    return _bucketed(_mark_hot(df, layout), layout).withColumn("_slice", F.when(F.col("_hot"), F.col("_slice")).otherwise(F.lit(0))).drop("_hot")


def dense_index(df: DataFrame, layout: SeriesLayout, out: str = "_i", total: str | None = None) -> DataFrame:
    """Add the 0-based position of each row in its series and, if named, the number of rows of the series."""
    if not layout.sliced:
        w = Window.partitionBy(*layout.series)
        cols = [(F.row_number().over(w.orderBy(*layout.order)) - 1).cast("long").alias(out)]
        if total:
            cols.append(F.count(F.lit(1)).over(w).alias(total))
        return df.select("*", *cols)
    keys = [*layout.series, "_slice"]
    cut = _sliced(df, layout)
    per_slice = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*layout.series)
    before = F.coalesce(F.sum("_n").over(w.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cols = [before.alias("_before")]
    if total:
        cols.append(F.sum("_n").over(w).alias(total))
    offsets = per_slice.select(*keys, *cols)
    joined = join_on(cut, offsets, keys, "inner")
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*layout.order)) - 1
    return joined.withColumn(out, (local + F.col("_before")).cast("long")).drop("_before", "_slice")


def over_series(
    df: DataFrame, layout: SeriesLayout, build: Callable[[WindowSpec], list[Column]], before: int = 0, after: int = 0,
    index: str | None = None
) -> DataFrame:
    """Add the columns `build(w)`, where `w` is the ordered window of a series.

    Each column may look at most `before` rows back and `after` rows ahead. Long series are cut into blocks that
    carry a copy of the neighbouring rows, so results equal those of one window over the series. `index` names a
    dense position that is already in the table.
    """
    if not layout.sliced:
        w = Window.partitionBy(*layout.series).orderBy(*layout.order)
        return df.select("*", *build(w))
    size = max(layout.rows_per_task, before, after, 1)
    indexed = df if index else dense_index(df, layout, "_i")
    at_row = index or "_i"
    own, at = F.floor(F.col(at_row) / size), F.col(at_row) % size
    copies = F.array_compact(F.array(
        own,
        F.when(at >= size - before, own + 1) if before else F.lit(None).cast("long"),
        F.when((at < after) & (own > 0), own - 1) if after else F.lit(None).cast("long"),
    ))
    spread = indexed.withColumn("_own", own).withColumn("_block", F.explode(copies))
    w = Window.partitionBy(*layout.series, "_block").orderBy(at_row)
    made = spread.select("*", *build(w)).filter(F.col("_own") == F.col("_block")).drop("_own", "_block")
    return made if index else made.drop("_i")


def series_stats(df: DataFrame, layout: SeriesLayout, aggs: dict[str, Column]) -> DataFrame:
    """Repeat whole-series aggregates on each row."""
    if not layout.sliced:
        w = Window.partitionBy(*layout.series)
        return df.select("*", *[a.over(w).alias(n) for n, a in aggs.items()])
    named = [a.alias(n) for n, a in aggs.items()]
    if not layout.series:
        row = df.agg(*named).first()
        kinds = df.limit(0).agg(*named).schema
        return df.select("*", *[F.lit(row[n]).cast(kinds[n].dataType).alias(n) for n in aggs])
    return lookup(df, df.groupBy(*layout.series).agg(*named), layout.series)


def block_of(layout: SeriesLayout, index: str = "_i") -> Column:
    """Block number of an indexed row: constant for short series."""
    if not layout.sliced:
        return F.lit(0).cast("long")
    return F.floor(F.col(index) / layout.rows_per_task)


def neighbours(df: DataFrame, layout: SeriesLayout, index: str, cols: Sequence[str]) -> DataFrame:
    """Add structs `_prev` and `_next` holding `cols` of the adjacent rows in index order; NULL at the ends.

    Adjacent rows may lie in far-away blocks, so block edges are matched over one small row per block.
    """
    keys = [*layout.series, "_block"]
    blocked = df.withColumn("_block", block_of(layout, index))
    w = Window.partitionBy(*keys).orderBy(index)
    row = F.struct(*cols)
    near = blocked.select("*", F.lag(row).over(w).alias("_prev"), F.lead(row).over(w).alias("_next"))
    if not layout.sliced:
        return near.drop("_block")
    edges = blocked.groupBy(*keys).agg(F.min_by(row, index).alias("_first"), F.max_by(row, index).alias("_last"))
    we = Window.partitionBy(*layout.series).orderBy("_block")
    edges = edges.select(*keys, F.lag("_last").over(we).alias("_lag"), F.lead("_first").over(we).alias("_lead"))
    return (join_on(near, edges, keys)
            .withColumn("_prev", F.coalesce("_prev", "_lag")).withColumn("_next", F.coalesce("_next", "_lead"))
            .drop("_lag", "_lead", "_block"))


def settled(df: DataFrame, layout: SeriesLayout, name: str) -> DataFrame:
    """Long series are read several times by the next steps, so their table is written once."""
    return materialise(df, name) if layout.sliced else df


def carry_forward(df: DataFrame, layout: SeriesLayout, index: str, col: str, out: str,
                  source: DataFrame | None = None) -> DataFrame:
    """Add the last non-NULL value of `col` at or before each row in index order.

    `source` may be a cheaper table with the same series, index and `col`, to find the value each block starts with.
    """
    keys = [*layout.series, "_block"]
    blocked = df.withColumn("_block", block_of(layout, index))
    w = Window.partitionBy(*keys).orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    held = blocked.withColumn(out, F.last(col, ignorenulls=True).over(w))
    if not layout.sliced:
        return held.drop("_block")
    if source is not None:
        blocked = source.withColumn("_block", block_of(layout, index))
    ends = blocked.groupBy(*keys).agg(F.max_by(col, F.when(F.col(col).isNotNull(), F.col(index))).alias("_end"))
    we = Window.partitionBy(*layout.series).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, F.last("_end", ignorenulls=True).over(we).alias("_held"))
    return join_on(held, ends, keys).withColumn(out, F.coalesce(out, "_held")).drop("_held", "_block")


def cumulative_share(counts: DataFrame, value: str, weight: str, rows_per_task: int | None = None) -> DataFrame:
    """For a table of distinct values with weights: add `_before`, the weight of all smaller values.

    The table can be as large as the data, so the running sum is taken per value range and range totals are added.
    """
    layout = series_layout(counts, (), (value,), rows_per_task)
    run = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    if not layout.sliced:
        return counts.withColumn("_before", F.coalesce(F.sum(weight).over(run), F.lit(0)))
    cut = _sliced(counts, layout)
    totals = cut.groupBy("_slice").agg(F.sum(weight).alias("_w"))
    totals = totals.select("_slice", F.coalesce(
        F.sum("_w").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (join_on(cut, totals, ["_slice"])
            .withColumn("_before", F.coalesce(F.sum(weight).over(inner), F.lit(0)) + F.col("_base"))
            .drop("_slice", "_base"))


def sorted_positions(values: DataFrame, col: str, out: str = "_i", total: str | None = None) -> DataFrame:
    """Dense positions of distinct values in sorted order, also of text.

    Text has no numeric position to cut by, so it is range-partitioned and sorted, and written with its place, which
    then stays fixed.
    """
    if isinstance(values.schema[col].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return dense_index(values, series_layout(values, (), (col,)), out, total)
    ranged = values.repartitionByRange(col).sortWithinPartitions(col).select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    table = materialise(ranged, "sorted")
    return dense_index(table, series_layout(table, (), ("_part", "_at")), out, total).drop("_part", "_at")
