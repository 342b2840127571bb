"""Rolling features and windowed samples over streams, with the tail of each series as state.

Rows of a series have to arrive in order across micro-batches; inside one they are sorted, by one order column or by
several, so that equal times are told apart. A row at or before the last one seen is returned with `late` set and takes
no part in features or samples. The rows of one series in one micro-batch are held
together, so the size of a micro-batch is a setting of the source (`maxFilesPerTrigger`, `maxOffsetsPerTrigger`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seriesml.operators.sequence import stride_of

ROLLING = {
    "sum": lambda r: r.sum(), "mean": lambda r: r.mean(), "maximum": lambda r: r.max(), "minimum": lambda r: r.min(),
    "standard_deviation": lambda r: r.std(),
}


def _orders(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _arrived(pdfs: Iterator[pd.DataFrame], order: list[str], last: list[int] | None) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Rows in order, and those that come too late."""
    rows = pd.concat(list(pdfs), ignore_index=True).sort_values(order, kind="stable")
    old = rows.duplicated(order)
    if last is not None:
        same = pd.Series(True, index=rows.index)
        for c, v in zip(order, last):  # column by column, the first difference decides
            old |= same & (rows[c] < v)
            same &= rows[c] == v
        old |= same
    return rows[~old].reset_index(drop=True), rows[old].reset_index(drop=True)


def rolling_stream(stream: DataFrame, series: str, order: str | Sequence[str], value: str, feature: str, n: int) -> DataFrame:
    """(series, order, value, <value>_<feature>, late): a trailing window of `n` rows per series."""
    kinds, order = dict(stream.dtypes), _orders(order)
    out = f"{value}_{feature}"
    schema = f"{series} {kinds[series]}, {', '.join(f'{c} bigint' for c in order)}, {value} double, {out} double, late boolean"
    roll = ROLLING[feature]

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tail, last = state.get if state.exists else ([], None)
        rows, late = _arrived(pdfs, order, last)
        values = pd.Series([*tail, *rows[value]], dtype=float)
        rolled = roll(values.rolling(n)).iloc[len(tail):].to_numpy()
        if len(rows):
            state.update((list(values.iloc[len(values) - min(n - 1, len(values)):]), [int(v) for v in rows[order].iloc[-1]]))
        every = pd.concat([rows, late], ignore_index=True)
        yield pd.DataFrame({series: key[0], **{c: every[c] for c in order}, value: every[value],
                            out: np.concatenate([rolled, np.full(len(late), np.nan)]),
                            "late": np.arange(len(every)) >= len(rows)})

    rows = stream.select(series, *[F.col(c).cast("bigint").alias(c) for c in order], F.col(value).cast("double").alias(value))
    made = rows.groupBy(series).applyInPandasWithState(
        step, schema, "tail array<double>, last array<bigint>", "append", GroupStateTimeout.NoTimeout)
    return made.withColumn(out, F.nanvl(F.col(out), F.lit(None).cast("double")))


def sample_stream(stream: DataFrame, series: str, order: str | Sequence[str], inputs: Sequence[str], window: int, overlap: int = 0) -> DataFrame:
    """(series, sample, x, late): windows of consecutive rows, complete ones as soon as their last row is there.

    A late row comes out on its own, with `late`, no sample number and its values as the only row of x.
    """
    kinds, order = dict(stream.dtypes), _orders(order)
    stride, width = stride_of(window, overlap), len(inputs)
    schema = f"{series} {kinds[series]}, sample bigint, x array<array<double>>, late boolean"

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, sample, last = state.get if state.exists else ([], 0, None)
        rows, late = _arrived(pdfs, order, last)
        cells = np.concatenate([np.asarray(held, dtype=float).reshape(-1, width), rows[list(inputs)].to_numpy(dtype=float)])
        count = max(0, (len(cells) - window) // stride + 1)
        found = [cells[k * stride:k * stride + window].tolist() for k in range(count)]
        if len(rows):
            # Rows before the next window start are no longer needed; a start beyond the rows seen cannot occur,
            # as the stride is never longer than the window.
            state.update((cells[count * stride:].ravel().tolist(), sample + count, [int(v) for v in rows[order].iloc[-1]]))
        alone = [[v] for v in late[list(inputs)].to_numpy(dtype=float).tolist()]
        numbers = pd.array([*range(sample, sample + count), *[None] * len(alone)], dtype="Int64")
        yield pd.DataFrame({series: [key[0]] * len(numbers), "sample": numbers, "x": found + alone, "late": np.arange(len(numbers)) >= count})

    rows = stream.select(series, *[F.col(c).cast("bigint").alias(c) for c in order], *[F.col(c).cast("double").alias(c) for c in inputs])
    return rows.groupBy(series).applyInPandasWithState(
        step, schema, "held array<double>, sample bigint, last array<bigint>", "append", GroupStateTimeout.NoTimeout)
