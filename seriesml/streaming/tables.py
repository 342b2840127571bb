"""Stateful streams whose state is a table: every micro-batch is one batch job over the new rows and the kept ones.

A run has one folder: `progress` (the checkpoint), `out/batch=<n>` (what batch n gave), `state/<n>` and `seen/<n>` (what is kept
after it). A batch reads the state of the one before and replaces whatever an interrupted attempt of itself has left, so a
restart repeats nothing. Rows are windowed by Spark: a series of any length in one micro-batch is cut into slices like any
other (`ordering`), and no Python process holds it. With an expiry, a series whose last row is older than the newest row of
all series by more than the delay is forgotten, so the state is bounded by the series that are alive.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesml.operators import features, sequence
from seriesml.operators.ordering import dense_index, join_on, series_layout
from seriesml.session import remove
from seriesml.streaming.stateful import ROLLING


@dataclass(frozen=True)
class Expiry:
    """The event-time column (a timestamp or a number of seconds) and how many seconds a series may be silent."""

    time: str
    delay: float


def _seconds(df: DataFrame, expiry: Expiry | None) -> Column:
    if expiry is None:
        return F.lit(None).cast("double")
    kind = dict(df.dtypes)[expiry.time]
    c = F.col(expiry.time)
    return (F.unix_micros(c.cast("timestamp")) / 1e6 if kind.startswith("timestamp") else c).cast("double")


@dataclass(frozen=True)
class _Batch:
    """The new rows of a micro-batch, its late ones, what is kept from before, and the newest time seen with it."""

    fresh: DataFrame
    late: DataFrame
    held: DataFrame
    newest: float | None
    written: Callable[[DataFrame, str], DataFrame]


def _arrived(rows: DataFrame, held: DataFrame, series: str, order: Sequence[str], newest: float | None, expiry: Expiry | None,
             written: Callable[[DataFrame, str], DataFrame]) -> _Batch:
    """A row is late when its order is not after the last one of its series, when another of the batch has the same order (one
    of them counts), or when it is older than an expiry allows. `held` has at least the last row of every series kept."""
    at = F.struct(*order)
    last = held.groupBy(series).agg(F.max(at).alias("_last"))
    number = F.row_number().over(Window.partitionBy(series, *order).orderBy("_time"))
    old = F.coalesce(at <= F.col("_last"), F.lit(False)) | (number > 1)
    if expiry is not None and newest is not None:
        old = old | F.coalesce(F.col("_time") < newest - expiry.delay, F.lit(False))
    marked = written(join_on(rows, last, [series]).withColumn("_late", old).drop("_last"), "arrived")
    top = marked.agg(F.max("_time")).first()[0]
    known = [t for t in (newest, top) if t is not None]
    return _Batch(marked.filter(~F.col("_late")).drop("_late"), marked.filter("_late").drop("_late"), held, max(known, default=None), written)


def _alive(kept: DataFrame, series: str, batch: _Batch, expiry: Expiry | None) -> DataFrame:
    if expiry is None or batch.newest is None:
        return kept
    silent = F.max("_time").over(Window.partitionBy(series)) < batch.newest - expiry.delay
    return kept.withColumn("_dead", F.coalesce(silent, F.lit(False))).filter(~F.col("_dead")).drop("_dead")


def _run(stream: DataFrame, folder: str, columns: list[Column], empty: str, step: Callable[[_Batch], tuple[DataFrame, DataFrame]],
         series: str, order: Sequence[str], expiry: Expiry | None, schema: str) -> DataFrame:
    """Process what is there now. `step` gives the batch's output and the rows to keep, `empty` is the schema of those."""
    spark = stream.sparkSession
    narrow = stream.select(*columns, _seconds(stream, expiry).alias("_time"))

    def process(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        state = lambda n: f"{folder}/state/{n}"
        held = session.read.schema(empty).parquet(state(number - 1)) if number else session.createDataFrame([], empty)
        newest = session.read.schema("newest double").parquet(f"{folder}/seen/{number - 1}").first()[0] if number else None

        def written(df: DataFrame, name: str) -> DataFrame:
            """Read more than once within the batch."""
            path = f"{folder}/work/{number}/{name}"
            df.write.mode("overwrite").parquet(path)
            return session.read.schema(df.schema).parquet(path)

        batch = _arrived(written(rows, "batch"), held, series, order, newest, expiry, written)
        out, kept = step(batch)
        out.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")
        _alive(kept, series, batch, expiry).write.mode("overwrite").parquet(state(number))
        session.createDataFrame([(batch.newest,)], "newest double").coalesce(1).write.mode("overwrite").parquet(f"{folder}/seen/{number}")
        # The state of the batch before is still needed if this one is repeated.
        for path in (f"work/{number}", f"state/{number - 2}", f"seen/{number - 2}"):
            remove(session, f"{folder}/{path}")

    run = narrow.writeStream.foreachBatch(process).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(f"{schema}, batch bigint").option("basePath", f"{folder}/out").parquet(f"{folder}/out").drop("batch")


def _names(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def rolling_table(stream: DataFrame, folder: str, series: str, order: str | Sequence[str], value: str, feature: str, n: int,
                  expiry: Expiry | None = None) -> DataFrame:
    """(series, order, value, <value>_<feature>, late): a trailing window of `n` rows per series over all batches so far.

    `feature` is one of the rolling features. A late row comes out with `late` and no feature. An expired series begins anew
    when it comes back.
    """
    if feature not in ROLLING:
        raise ValueError(f"{feature} is not one of {', '.join(ROLLING)}")
    order, out, keep = _names(order), f"{value}_{feature}", max(n - 1, 1)
    kinds = dict(stream.dtypes)
    head = ", ".join([f"{series} {kinds[series]}", *[f"{c} {kinds[c]}" for c in order], f"{value} double"])
    columns = [F.col(series), *[F.col(c) for c in order], F.col(value).cast("double").alias(value)]

    def step(batch: _Batch) -> tuple[DataFrame, DataFrame]:
        both = batch.held.withColumn("_new", F.lit(False)).unionByName(batch.fresh.withColumn("_new", F.lit(True)))
        layout = series_layout(both, [series], order)
        made = features.engineer(both, layout, {feature: [value]}, dict.fromkeys(("sum", "mean", "max_min", "standard_deviation"), n)).filter("_new")
        names = [series, *order, value]
        late = batch.late.select(*names, F.lit(None).cast("double").alias(out), F.lit(True).alias("late"))
        kept = dense_index(both, layout, "_i", "_n").filter(F.col("_i") >= F.col("_n") - keep)
        return made.select(*names, out, F.lit(False).alias("late")).unionByName(late), kept.select(*names, "_time")

    return _run(stream, folder, columns, f"{head}, _time double", step, series, order, expiry, f"{head}, {out} double, late boolean")


def sample_table(stream: DataFrame, folder: str, series: str, order: str | Sequence[str], inputs: Sequence[str], window: int,
                 overlap: int = 0, expiry: Expiry | None = None) -> DataFrame:
    """(series, sample, x, late): windows of consecutive rows over all batches so far, complete ones as soon as their last row is there.

    A late row comes out on its own, with `late`, no sample number and its values as the only row of x.
    """
    order, stride = _names(order), sequence.stride_of(window, overlap)
    kinds = dict(stream.dtypes)
    rows = ", ".join([f"{series} {kinds[series]}", *[f"{c} {kinds[c]}" for c in order], *[f"{c} double" for c in inputs if c not in order]])
    columns = [F.col(series), *[F.col(c) for c in order], *[F.col(c).cast("double").alias(c) for c in inputs if c not in order]]
    names = [series, *order, *[c for c in inputs if c not in order]]

    def step(batch: _Batch) -> tuple[DataFrame, DataFrame]:
        # `_sample` is the number of the next window; a row before its start is kept only to tell late rows.
        base = batch.held.groupBy(series).agg(F.max("_sample").alias("_sample"))
        both = batch.written(batch.held.filter(~F.col("_spent")).select(*names, "_time").unionByName(batch.fresh.select(*names, "_time")), "rows")
        layout = series_layout(both, [series], order)
        found = join_on(sequence.input_sequences(both, layout, inputs, window, overlap), base, [series])
        number = F.col("sample") + F.coalesce("_sample", F.lit(0))
        late = batch.late.select(series, F.lit(None).cast("bigint").alias("sample"),
                                 F.array(F.array(*[F.col(c).cast("double") for c in inputs])).alias("x"), F.lit(True).alias("late"))
        made = found.select(series, number.cast("bigint").alias("sample"), "x", F.lit(False).alias("late"))
        placed = join_on(dense_index(both, layout, "_i", "_n"), base, [series])
        count = F.greatest(F.lit(0), F.floor((F.col("_n") - window) / stride) + 1)
        spent = F.col("_i") < count * stride
        kept = placed.withColumn("_spent", spent).filter(~F.col("_spent") | (F.col("_i") == F.col("_n") - 1))
        kept = kept.select(*names, "_time", (F.coalesce("_sample", F.lit(0)) + count).cast("bigint").alias("_sample"), "_spent")
        # A series whose held rows are all spent and that has no new rows stays as it is.
        silent = join_on(batch.held.filter("_spent"), both.select(series).distinct(), [series], "left_anti")
        return made.unionByName(late), kept.unionByName(silent.select(*kept.columns))

    return _run(stream, folder, columns, f"{rows}, _time double, _sample bigint, _spent boolean", step, series, order, expiry,
                f"{series} {kinds[series]}, sample bigint, x array<array<double>>, late boolean")


def replacing_table(stream: DataFrame, folder: str) -> DataFrame:
    """A stateless stream into `out/batch=<n>`: a repeated batch replaces what it wrote before."""
    spark = stream.sparkSession

    def process(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")
    run = stream.writeStream.foreachBatch(process).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    run.awaitTermination()
    schema = stream.schema.add("batch", "long")
    return spark.read.schema(schema).option("basePath", f"{folder}/out").parquet(f"{folder}/out").drop("batch")
