"""Token ids in ORC files: run-length coded integers, row indexes and Bloom filters on the document id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesml.llm.common import documents, joined
from seriesml.llm.tokens import encoder

_ROWS = "doc_id {id}, local_start long, n_tokens long, ids array<int>"


def _encoded(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at, end = encoder(path), 0, np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            packed = [enc.encode(t) + end for t in batch.column(1).to_pylist()]
            enc.trim()
            sizes = np.array([len(p) // 4 for p in packed], dtype=np.int64)
            starts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts), pa.array(sizes), ids],
                                             names=["doc_id", "local_start", "n_tokens", "ids"])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, stripe_mb: int = 16) -> None:
    """Encode every whole text, append `end_id`, and write ORC under `path` in ascending document id.

    Texts go through one range shuffle, so each file holds a range of ids and each task encodes its own range. NULL texts
    are empty and give the end id only; a NULL id comes first; rows with the same id are ordered by their text; an empty
    table gives an empty folder with a schema. `path`-files holds one row for each file: its id range, documents, tokens and
    the tokens before it. Needs a folder that all executors reach.
    """
    df = documents(docs)
    kind = dict(df.dtypes)["doc_id"]
    ordered = df.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (ordered.mapInArrow(_encoded(tokenizer, end_id), _ROWS.format(id=kind)).write
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", "1000").option("orc.stripe.size", str(stripe_mb << 20)).option("compression", "zstd")
     .orc(path))
    rows = _files(docs.sparkSession, path, kind)
    per_file = rows.groupBy("file").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
                                        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    # One row a file, some 100 MB of tokens each; files are numbered in the order of their ranges.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_file.withColumn("start", before).write.orc(f"{path}-files")


def _files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(_ROWS.format(id=kind)).orc(path).select("*", F.col("_metadata.file_name").alias("file"))


def read_tokens(spark: SparkSession, path: str, id_type: str = "long", first_id=None, last_id=None) -> DataFrame:
    """doc_id, start, n_tokens, ids of the documents between two ids (all by default).

    Files are pruned by the table of files, row groups by their indexes and, for one id, by the Bloom filter.
    """
    rows = _files(spark, path, id_type)
    files = spark.read.schema(f"file string, first_id {id_type}, last_id {id_type}, n_docs long, n_tokens long, start long").orc(f"{path}-files")
    if first_id is not None:
        rows, files = rows.filter(F.col("doc_id") >= first_id), files.filter(F.col("last_id") >= first_id)
    if last_id is not None:
        rows, files = rows.filter(F.col("doc_id") <= last_id), files.filter(F.col("first_id") <= last_id)
    both = joined(rows, files.select("file", F.col("start").alias("file_start")), ["file"], "inner")
    return both.select("doc_id", (F.col("file_start") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib
    for batch in batches:
        ids = batch.column(3)
        values, offsets = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4"), ids.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(tokens: DataFrame) -> DataFrame:
    """crc32 of each document's ids as little-endian unsigned 32-bit integers."""
    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        _checksums, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
