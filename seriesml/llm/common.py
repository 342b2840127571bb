"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of fixed width (a few numbers each) that may be broadcast; 16 bytes a row make 16 MB.
BROADCAST_ROWS = 1_000_000
#: Bytes of text that a Python worker takes in hand at a time, unless one text is longer.
SLICE_BYTES = 4 << 20


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, the text never NULL. Other columns, whatever their names, stay out of an operator."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def row_key() -> F.Column:
    """Identity of a document row: rows equal in id and text are one document and get the same answer."""
    return F.xxhash64("doc_id", "text")


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str, rows: int | None = None) -> DataFrame:
    """Join on `keys`. `right` holds a few numbers a row and is written already; it is counted (or `rows` says its count),
    broadcast up to BROADCAST_ROWS, and shuffled beyond, where adaptive execution splits skewed keys."""
    if (right.count() if rows is None else rows) <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return left.join(right, keys, how)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """`docs` as it is with the key of each row in a column of a free name, and that name."""
    name = free_name(docs, "row_key")
    return docs.withColumn(name, F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))), name


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in slices of about `size` bytes of the texts in `column`; a longer text is a slice with its neighbours."""
    for batch in batches:
        if batch.num_rows:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
            cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield batch.slice(a, b - a)
