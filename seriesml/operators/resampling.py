"""Linear models on many resamples of a table from one pass over it.

A resample gives each row a whole weight that depends on its ids alone. Least squares needs no more of a resample than its
weighted sums and cross products, so every task adds up those of all draws at once, and each draw is solved from its own.
The hashes of all draws are taken together, a slice of rows at a time, as arithmetic on whole arrays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# P(at most n) of a Poisson distribution of mean 1, from n = 0 on.
POISSON_ONE = (0.36787944117, 0.73575888234, 0.91969860293, 0.98101184312, 0.99634015317, 0.99940581518, 0.99991675885, 0.99998975080)
# Numbers that are summed per task and reach the driver: draws times the square of the columns.
MAX_CELLS = 20_000_000
# Weights that a task holds at once, and hashes that are taken together.
WEIGHTS, HASHES = 4_000_000, 16_384
# MD5 (RFC 1321): constants and rotations of its 64 steps, and the words it starts from.
_STEPS = np.array([int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)], dtype=np.uint32)
_TURNS = [t for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in four * 4]
_START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], dtype=np.uint32)


def times(ids: Sequence[str], draw: Column, seed: int = 0) -> Column:
    """How often a row stands in a draw: a Poisson number of mean 1 from a hash of its ids, the same on any cluster."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids], draw.cast("string"), F.lit(str(seed)))
    u = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return F.size(F.filter(F.lit(list(POISSON_ONE)), lambda p: p <= u))


def _md5_block(words: Sequence[np.ndarray], state: Sequence[np.ndarray], shape: tuple[int, int], last: bool) -> list[np.ndarray]:
    """The state after one block of 16 words, each of which broadcasts to `shape`; of the last block only the first word is worked out."""
    a, b, c, d = (np.broadcast_to(x, shape).copy() for x in state)
    f, t = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for i in range(61 if last else 64):  # the first word of a state is settled three steps before the end
        if i < 16:
            g = i
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            g = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            g = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            g = 7 * i % 16
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += words[g] + _STEPS[i]
        np.left_shift(f, np.uint32(_TURNS[i]), out=t)
        f >>= np.uint32(32 - _TURNS[i])
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    if last:
        return [b + state[0]]
    return [x + y for x, y in zip((a, b, c, d), state)]


def _first_words(stems: np.ndarray, ends: Sequence[bytes]) -> np.ndarray:
    """(ends, rows): the first eight hexadecimal digits of the MD5 of every stem followed by every end, as a number.

    `stems` is (rows, bytes); ends are of one length.
    """
    rows, length = stems.shape
    whole = length + len(ends[0])
    size = (whole + 9 + 63) // 64 * 64
    fixed = np.zeros((len(ends), size), np.uint8)
    for one, end in zip(fixed, ends):
        one[length:whole], one[whole] = np.frombuffer(end, np.uint8), 128
    fixed[:, -8:] = np.frombuffer((whole * 8).to_bytes(8, "little"), np.uint8)
    varied = np.zeros((rows, (length + 3) // 4 * 4), np.uint8)
    varied[:, :length] = stems
    fixed, varied = fixed.view("<u4").T[:, :, None], np.ascontiguousarray(varied.view("<u4").T)[:, None, :]
    words = [fixed[i] | varied[i] if i < len(varied) else fixed[i] for i in range(size // 4)]
    state = list(_START.reshape(4, 1, 1))
    for at in range(0, len(words), 16):
        state = _md5_block(words[at:at + 16], state, (len(ends), rows), at + 16 == len(words))
    return state[0].byteswap()


def all_times(texts: pa.Array, draws: int, seed: int = 0) -> np.ndarray:
    """(rows, draws): `times` of all draws, given the ids of each row as one text (`id_text`)."""
    texts = texts.cast(pa.large_binary())
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data, lengths = np.frombuffer(texts.buffers()[2] or b"", np.uint8), np.diff(starts)
    limits = [np.uint32(math.ceil(p * 2 ** 32)) for p in POISSON_ONE]
    out = np.zeros((draws, len(texts)), np.uint8)
    ends = [f"{d}:{seed}".encode() for d in range(draws)]
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for a in range(0, len(rows), HASHES):
            some = rows[a:a + HASHES]
            stems = data[starts[some][:, None] + np.arange(length)]
            first = 0
            while first < draws:
                last = first + 1
                while last < draws and len(ends[last]) == len(ends[first]) and (last + 1 - first) * len(some) <= HASHES:
                    last += 1
                found = _first_words(stems, ends[first:last])
                count = np.zeros(found.shape, np.uint8)
                for limit in limits:
                    count += found >= limit
                out[first:last, some] = count
                first = last
    return out.T


def id_text(ids: Sequence[str]) -> Column:
    """What `times` hashes of a row before the number of the draw."""
    return F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids], F.lit(""))


@dataclass(frozen=True)
class LinearDraws:
    """Coefficients (draws, features) and intercepts of the draws that have rows, and their numbers."""

    draws: tuple[int, ...]
    coefficients: np.ndarray
    intercepts: np.ndarray

    def predict(self, df: DataFrame, ids: Sequence[str]) -> DataFrame:
        """(ids, draw, y_pred) of all draws from one scan of the vector column `features`."""
        coef, intercepts = self.coefficients, self.intercepts

        @F.arrow_udf("array<double>")
        def score(x: pa.Array) -> pa.Array:
            made = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), coef.shape[1]) @ coef.T + intercepts
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(intercepts)), pa.array(made.ravel()))

        made = df.select(*ids, F.posexplode(score(vector_to_array("features"))).alias("_at", "y_pred"))
        return made.select(*ids, F.element_at(F.lit(list(self.draws)), F.col("_at") + 1).alias("draw"), "y_pred")


def fits(draws: int, features: int) -> bool:
    """Whether the sums of all draws are few enough for one pass."""
    return draws * (features + 2) ** 2 <= MAX_CELLS


def _listed(weights: pa.Array) -> np.ndarray:
    return weights.flatten().to_numpy(zero_copy_only=False).reshape(len(weights), -1)


def cross_products(train: DataFrame, weights: Column, groups: int, read: Callable[[pa.Array], np.ndarray] = _listed) -> tuple[np.ndarray, np.ndarray, float]:
    """(groups, features + 2, features + 2) weighted sums of the products of 1, the features and the label, less the first row's
    features and label, which come with them. `weights` is an array with a weight for each group, or what `read` makes
    (rows, groups) of. One scan; tasks send their sums, and Spark adds them up.
    """
    first = train.select("features", "label").first()
    if first is None:
        raise ValueError("no training rows")
    centre, middle = np.asarray(first["features"].toArray()), float(first["label"])
    p = len(centre) + 2
    if not fits(groups, len(centre)):
        raise ValueError(f"{groups} groups of {len(centre)} features have more than {MAX_CELLS} sums")
    rows = train.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), weights.alias("w"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((groups, p * p))
        step = max(1, WEIGHTS // max(p * p, groups))
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                z = np.empty((batch.num_rows, p))
                z[:, 0] = 1.0
                z[:, 1:-1] = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - centre
                z[:, -1] = batch.column(1).to_numpy(zero_copy_only=False) - middle
                w = read(batch.column(2))
                total += w.T.astype(float) @ (z[:, :, None] * z[:, None, :]).reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(groups), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["group", "cells"])

    parts = rows.mapInArrow(sums, "group int, cells array<double>").select("group", F.posexplode("cells").alias("at", "v"))
    got = parts.groupBy("group", "at").agg(F.sum("v").alias("v")).toPandas()
    table = np.zeros((groups, p * p))
    table[got["group"], got["at"]] = got["v"]
    return table.reshape(groups, p, p), centre, middle


def solve(cells: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of one group's sums; of equally good coefficients the smallest."""
    n = cells[0, 0]
    mean = cells[0, 1:] / n
    spread = cells[1:, 1:] - n * np.outer(mean, mean)
    b = np.linalg.lstsq(spread[:-1, :-1] + alpha * np.eye(len(mean) - 1), spread[:-1, -1], rcond=1e-12)[0]
    return b, float(mean[-1] - b @ mean[:-1])


def bootstrap_linear(train: DataFrame, ids: Sequence[str], draws: int, seed: int = 0, alpha: float = 0.0) -> LinearDraws:
    """Least squares with a free intercept, or ridge with the penalty `alpha` on the sum of squares, for every draw.

    `train` has the ids, the vector column `features` and `label`. One scan; tasks send draws times (features + 2) squared
    numbers, summed by Spark. Sums are taken around the first row for accuracy. Of equally good coefficients the smallest are taken.
    """
    table, centre, middle = cross_products(train, id_text(ids), draws, lambda texts: all_times(texts, draws, seed))
    p = len(centre) + 2
    known, coefficients, intercepts = [], [], []
    for d, cells in enumerate(table):
        if not cells[0, 0]:
            continue
        b, at = solve(cells, alpha)
        known.append(d)
        coefficients.append(b)
        intercepts.append(middle + at - b @ centre)
    return LinearDraws(tuple(known), np.array(coefficients).reshape(len(known), p - 2), np.array(intercepts))
