"""Ranked lexical search: impact-sorted lists are read level by level, with a score interval for each document, until the
best documents, their order and their scores are settled (no random access).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesml.llm.common import documents, slices
from seriesml.session import materialise

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_CAPITALS = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
#: Documents whose lists are sorted and searched together in a task.
SHARD = 8192
#: Items, and characters of items, that are searched in one pass over the documents; more items take more passes.
BLOCK_ITEMS, BLOCK_CHARS = 2_000, 4_000_000


def terms_of(text: str) -> list[str]:
    return [t.translate(_CAPITALS) for t in _TERM.findall(text)]


class _Numbers(dict):
    """A term as it stands in a text to its number in the vocabulary, or -1; bounded between slices."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, term: str) -> int:
        made = self[term] = self.vocabulary.get(term.translate(_CAPITALS), -1)
        return made


def _counted(vocabulary: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, width = _Numbers(vocabulary), max(len(vocabulary), 1)
        for batch in slices(batches, 1):
            parts = []
            for text in batch.column(1).to_pylist():
                found = _TERM.findall(text)
                parts.append(np.fromiter(map(numbers.__getitem__, found), dtype=np.int64, count=len(found)))
            if len(numbers) > 200_000:
                numbers.clear()
            n = np.array([len(p) for p in parts], dtype=np.int64)
            flat, owner = np.concatenate(parts), np.repeat(np.arange(len(n)), n)
            known = flat >= 0
            cells, tf = np.unique(owner[known] * width + flat[known], return_counts=True)
            offsets = pa.array(np.searchsorted(cells, np.arange(len(n) + 1) * width).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (cells % width, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], names=["doc_id", "n", "terms", "tfs"])
    return run


def count_terms(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id, n (all terms with repeats), terms (numbers in `vocabulary`, ascending), tfs, of documents with a term."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(_counted(vocabulary), f"doc_id {kind}, n long, terms array<int>, tfs array<int>").filter("n > 0")


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        got = np.bincount(batch.column(0).flatten().to_numpy())
        if len(got) > len(total):
            got, total = total, got.astype(np.int64)
        total[:len(got)] += got
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "n"])


def weights(counted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, their terms, and each term's weight; a number for each term of the vocabulary reaches the driver."""
    n, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, dtype=np.int64)
    per = counted.select("terms").mapInArrow(_document_frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in per.collect():
        df[r["term"]] = r["n"]
    return n, total, np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def settle(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the `k` best of `size` documents, best first, of equal scores the smaller place; none below `least`.

    Each list holds places and their impacts, negated and ascending, all below 0. Lists are read from the top only, a level
    of impact at a time. A document's lower bound is what was read of it; its upper bound adds, for each list that has not
    named it, the next impact of that list. Documents whose upper bound is below the k-th lower bound are out. Reading
    ends when no document that is still unnamed can come in and every document that is left has an interval of one number.
    """
    at, lower, alive = [0] * len(lists), np.zeros(size), np.ones(size, dtype=bool)
    named, source = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    level = max((-down[0] for _, down in lists if len(down)), default=0)
    closed = False
    while True:
        met, of, gains = [], [], []
        ahead = np.zeros(len(lists))
        for t, (places, down) in enumerate(lists):
            start = at[t]
            if start < len(down):
                end = at[t] = start + int(np.searchsorted(down[start:], -level, side="right"))
                if end > start:
                    met.append(places[start:end])
                    of.append(np.full(end - start, t))
                    gains.append(down[start:end])
                if end < len(down):
                    ahead[t] = -down[end]
        if met:
            met, of, gains = np.concatenate(met), np.concatenate(of), np.concatenate(gains)
            if closed:
                still = alive[met]
                met, of, gains = met[still], of[still], gains[still]
            lower -= np.bincount(met, weights=gains, minlength=size)
            named, source = np.concatenate([named, met]), np.concatenate([source, of])
        bound = max(least, np.partition(lower, size - k)[size - k] if size >= k else 0)
        total = ahead.sum()
        if total < bound:
            unknown = total - np.bincount(named, weights=ahead[source], minlength=size)
            alive &= lower + unknown >= bound
            closed = True
            still = alive[named]
            named, source = named[still], source[still]
            if not unknown[alive].any():
                break
        level = level / 2 if level >= 1 else 0
    left = np.flatnonzero(alive)
    left = left[np.argsort(-lower[left], kind="stable")[:k]]
    return left, lower[left].astype(np.int64)


def _searched(queries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, n_docs: int, n_terms: int, k: int, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, dtype=np.int64) for _ in queries]  # of this task so far

        def searched(table: pa.Table) -> pa.RecordBatch:
            table = table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending")], null_placement="at_start"))
            n, size = table.column("n").to_numpy(), len(table)
            terms, tf = (table.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
            owner = np.repeat(np.arange(size), pc.list_value_length(table.column("terms")).to_numpy())
            m = 25 + (75 * n * n_docs) // n_terms
            down = -(weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])))
            order = np.lexsort((down, terms))
            order = order[down[order] < 0]
            terms, down, owner = terms[order], down[order], owner[order]
            items, places, scores = [], [], []
            for i, (wanted, times) in enumerate(queries):
                a, b = np.searchsorted(terms, wanted), np.searchsorted(terms, wanted, side="right")
                lists = [(owner[x:y], down[x:y] * c) for x, y, c in zip(a, b, times) if x < y]
                if lists:
                    at, score = settle(lists, size, k, int(best[i][-1]) if len(best[i]) == k else 1)
                    best[i] = -np.sort(-np.concatenate([best[i], score]))[:k]
                    items += [i] * len(at)
                    places += at.tolist()
                    scores += score.tolist()
            return pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), table.column("doc_id").combine_chunks().take(pa.array(places, pa.int64())),
                                               pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])
        held, rows = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, shard):
                held.append(batch.slice(a, shard))
                rows += held[-1].num_rows
                if rows >= shard:
                    yield searched(pa.Table.from_batches(held))
                    held, rows = [], 0
        if held:
            yield searched(pa.Table.from_batches(held))
    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of a bounded number and length."""
    held, chars = [], 0
    for r in items.toLocalIterator():
        held.append((r["row"], r["text"]))
        chars += len(r["text"])
        if len(held) >= BLOCK_ITEMS or chars >= BLOCK_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` best documents of every item with a score above 0, all of them if there are fewer.

    Documents are counted once for a block of items: the terms that the items hold and the numbers of all terms. Each task
    sorts its documents' lists by impact, `shard` documents at a time, and reads them until the best are settled; later
    shards of a task begin with the score that the earlier ones reached. The best of all tasks are then ranked in Spark, at
    most `k` for each item and shard. Equal scores are ranked by ascending id, a NULL id first. NULL texts and texts without a
    term are never found; repeated rows are found each by itself; each row of `items` is an item, whatever its id; an
    empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.coalesce(F.col(f"`{item_text_col}`").cast("string"), F.lit("")).alias("text"))
    asked = materialise(asked.withColumn("row", F.monotonically_increasing_id()), "items")
    found = None
    for block in _blocks(asked):
        per = [Counter(terms_of(text)) for _, text in block]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*per)))}
        counted = materialise(count_terms(documents(docs, id_col, text_col), vocabulary), "terms")
        n_docs, n_terms, weight = weights(counted, len(vocabulary))
        queries = [(np.array([vocabulary[t] for t in c], dtype=np.int64), np.array(list(c.values()), dtype=np.int64)) for c in per]
        best = counted.mapInArrow(_searched(queries, weight, n_docs, n_terms, k, shard), f"item int, doc_id {kind}, score long")
        rows = spark.createDataFrame([(i, row) for i, (row, _) in enumerate(block)], "item int, row long")
        best = best.join(F.broadcast(rows), "item").select("row", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], f"row long, doc_id {kind}, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return asked.select("row", "item_id").join(top, "row").select("item_id", "rank", "doc_id", "score")
