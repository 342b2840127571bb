"""Vector best-fit packing of token pieces into sequences under token, document and attention-cost limits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesml.llm.common import documents, joined, slices
from seriesml.llm.tokens import CACHED_WORDS, encoder
from seriesml.session import materialise

#: Numbers within one length are counted in so many parts, or more when there are more than PART_ROWS pieces in each.
PARTS, PART_ROWS = 256, 200_000


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence. The attention cost of a piece is the square of its length.

    Without `documents` or `attention` the two are the bounds that `tokens` sets anyway. `weights` are for tokens,
    documents and attention; `rule` is `norm` (the smallest weighted norm of what stays free) or `dot` (the largest
    weighted product of the piece and what is free).
    """

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)
    rule: str = "norm"

    def capacity(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens ** 2], dtype=np.int64)


def plan_packing(counts: dict[int, int], limits: Limits = Limits()) -> pd.DataFrame:
    """Where the pieces of each length go, from the number of pieces of each length alone.

    Bins with the same content are one group with a multiplicity. Lengths are taken in descending order; each takes the
    best group in which it fits in every dimension, or opens bins. Rows: the pieces numbered rank_from to rank_to - 1 of
    `length` go to the bins from `sequence` on, `each` in a bin, the first of a bin at `offset`. The work depends on the
    number of lengths, not of pieces.
    """
    cap = limits.capacity()
    weight = np.asarray(limits.weights, dtype=float)
    free, many, first, used = [np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64),
                               np.zeros(0, dtype=np.int64)]
    rows, bins = [], 0
    for length in sorted(counts, reverse=True):
        item = np.array([length, 1, length * length], dtype=np.int64)
        if (item > cap).any():
            raise ValueError(f"a piece of {length} tokens fits into no sequence of {cap.tolist()}")
        left, rank = counts[length], 0
        while left:
            fits = np.flatnonzero((free >= item).all(axis=1))
            if len(fits):
                if limits.rule == "dot":
                    g = fits[np.argmax(((free[fits] / cap) * (item / cap) * weight).sum(axis=1))]
                else:
                    g = fits[np.argmin((((free[fits] - item) / cap) ** 2 * weight).sum(axis=1))]
                each = int(min((free[g] // item).min(), left)) if limits.rule != "dot" else 1
                n = int(min(many[g], left // each))
                if n < many[g]:  # the rest of the group stays as it is
                    free, many = np.vstack([free, free[g]]), np.append(many, many[g] - n)
                    first, used = np.append(first, first[g] + n), np.append(used, used[g])
                    many[g] = n
            else:
                each = int(min((cap // item).min(), left)) if limits.rule != "dot" else 1
                n, g = left // each, len(many)
                free, many = np.vstack([free, cap]), np.append(many, n)
                first, used = np.append(first, bins), np.append(used, 0)
                bins += n
            rows.append((length, rank, rank + n * each, each, int(first[g]), int(used[g])))
            free[g] -= item * each
            used[g] += length * each
            rank, left = rank + n * each, left - n * each
        open_ = free[:, 0] > 0
        free, many, first, used = free[open_], many[open_], first[open_], used[open_]
    return pd.DataFrame(rows, columns=["length", "rank_from", "rank_to", "each", "sequence", "offset"]).astype("int64")


def _cut(path: str, end_id: int, size: int, cached: int, forget: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, cached), np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, 1):
            row, piece, start, part = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                packed = enc.encode(text) + end
                for n, at in enumerate(range(0, len(packed), 4 * size)):
                    row.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    part.append(packed[at:at + 4 * size])
            enc.trim()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array([len(p) // 4 for p in part], pa.int64()), pa.array(part, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])
        if forget:
            enc.forget()
            pa.default_memory_pool().release_unused()
    return run


def encode_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int = 2048, cached: int = CACHED_WORDS, forget: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit integers) of every whole text with its end id.

    Texts of more than `size` ids are cut; only the last piece may be shorter. A NULL text is the end id alone. Rows with
    the same id are cut apart from each other; an empty table gives none. Python workers remember `cached` words, from task
    to task unless `forget` is set: workers live on, and their memory would stay taken in whatever they do next.
    """
    df = documents(docs)
    kind = dict(df.dtypes)["doc_id"]
    return df.mapInArrow(_cut(tokenizer, end_id, size, cached, forget), f"doc_id {kind}, piece int, start long, length long, ids binary")


def _placed(plan: pd.DataFrame):
    by = {n: g.sort_values("rank_from") for n, g in plan.groupby("length")}
    by = {n: {c: g[c].to_numpy() for c in g} for n, g in by.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                g = by[n]
                k = np.searchsorted(g["rank_from"], rank[at], side="right") - 1
                nth = rank[at] - g["rank_from"][k]
                sequence[at] = g["sequence"][k] + nth // g["each"][k]
                offset[at] = g["offset"][k] + nth % g["each"][k] * n
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in names]
                                             + [pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`pieces` (written already; any columns besides length and ids; no rank, part, base) with sequence_id and offset.

    Only the number of pieces of each length (at most `limits.tokens` rows) reaches the driver. Pieces are numbered within
    their length in parts by a hash of the row, so a length that holds a third of all pieces is spread as well; equal
    rows get different places. An empty table gives an empty result.
    """
    pieces = pieces.drop("ids")
    counts = {int(r["length"]): r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(counts, limits)
    parts = max(PARTS, -(-sum(counts.values()) // PART_ROWS))
    columns = pieces.columns
    cut = pieces.withColumn("part", F.pmod(F.xxhash64(*columns), F.lit(parts)))
    per_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = joined(cut, base, ["length", "part"], "inner", rows=len(counts) * parts)
    within = Window.partitionBy("length", "part").orderBy(*[c for c in columns if c != "length"])
    ranked = numbered.withColumn("rank", F.col("base") + F.row_number().over(within) - 1).select(*columns, "rank")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_placed(plan), f"{kinds}, sequence_id long, offset long")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids of whole sequences: the pieces' ids joined in the order of their offsets.

    `pieces` has ids; each sequence is bounded by the capacities of the packing. Documents have unique ids here.
    """
    both = placed.join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return both.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id", "n_tokens", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(), cached: int = CACHED_WORDS, forget: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of `docs`; `cached` and `forget` as in encode_pieces."""
    pieces = encode_pieces(docs, tokenizer, end_id, limits.tokens, cached, forget)
    narrow = materialise(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(narrow, limits)
