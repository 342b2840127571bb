"""k-nearest neighbours without comparing every pair: exact by cells, or approximate by hash tables.

Exact: training rows are assigned to the nearest of a number of pivots that grows with the table. A query first searches
its own cell; the distance of the k-th row found there bounds what it still has to look for, and the triangle inequality
rules out whole cells. Approximate: the signs of random projections are the keys of several hash tables; a query meets the
rows of its own bucket in each table and of the buckets beyond its nearest planes.

Either way a bucket is matched in blocks of a bounded number of rows and queries, so no task holds more than a block of each,
and each block returns k rows per query at most. Beyond its own cell, a query is not written out for each cell: near cells make
a part of the queries, which a task holds while the rows of all cells that the part needs pass by.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesml.operators.ordering import lookup
from seriesml.operators.split import seeded_key
from seriesml.session import materialise

K = 5
# Pivots reach every task of a search: their number is the square root of the rows up to here.
MAX_PIVOTS = 2048
BLOCK_ROWS = 20_000
# Cells of the table (query, row) that a part looks at together, candidates whose distances are taken together, and the fewest queries of a part.
SCREENED, CANDIDATES, LEAST_PART = 4_000_000, 100_000, 500
# Hash tables, buckets that a query visits in each, and the rows of a bucket when rows are spread evenly.
HASH_TABLES, HASH_PROBES, BUCKET_ROWS = 10, 8, 500


@dataclass(frozen=True)
class NeighbourModel:
    """Training rows (id, x, label, cell) with the pivots and the radius and rows of each cell."""

    table: DataFrame
    id: str
    k: int
    pivots: np.ndarray
    radius: np.ndarray
    rows: np.ndarray
    block: int


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0.0))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(float)


def _vector(df: DataFrame, x: str) -> Column:
    """The vectors as they are stored, if as numbers of single or double precision; distances are taken in double precision."""
    kinds = (T.ArrayType(T.FloatType(), True), T.ArrayType(T.FloatType(), False))
    return (F.col(x) if df.select(x).schema[0].dataType in kinds else F.col(x).cast("array<double>")).alias("_x")


def _nearest_pivot(centres: np.ndarray):
    @F.pandas_udf("struct<cell:int,away:double>")
    def assign(values: pd.Series) -> pd.DataFrame:
        cell, away = np.zeros(len(values), dtype="int32"), np.zeros(len(values))
        for a in range(0, len(values), 1024):
            d = _distances(_matrix(values.iloc[a:a + 1024]), centres)
            cell[a:a + 1024] = d.argmin(axis=1)
            away[a:a + 1024] = d.min(axis=1)
        return pd.DataFrame({"cell": cell, "away": away})
    return assign


def fit_neighbours(train: DataFrame, id: str, x: str, label: str, k: int = K, pivots: int | None = None,
                   block: int = BLOCK_ROWS, seed: int = 0) -> NeighbourModel:
    """Assign the training rows to pivots. `k` is the largest number of neighbours that will be asked for."""
    rows = train.select(F.col(id).alias("_id"), _vector(train, x), F.col(label).alias("_label"))
    total = rows.count()
    count = pivots or max(1, min(MAX_PIVOTS, int(math.sqrt(total) / 2)))
    chosen = rows.orderBy(seeded_key(["_id"], seed), "_id").limit(count).select("_x").collect()
    if not chosen:
        raise ValueError("no training rows")
    centres = np.stack([np.asarray(r["_x"]) for r in chosen])
    placed = rows.withColumn("_a", _nearest_pivot(centres)("_x")).select(
        "_id", "_x", "_label", F.col("_a.cell").alias("_cell"), F.col("_a.away").alias("_away"))
    placed = materialise(placed, "cells")  # read by the statistics and by every search
    radius, sizes = np.full(len(centres), -1.0), np.zeros(len(centres), dtype="int64")
    for f in placed.groupBy("_cell").agg(F.max("_away").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[f["_cell"]], sizes[f["_cell"]] = f["r"], f["n"]
    return NeighbourModel(placed.drop("_away"), id, k, centres, radius, sizes, block)


def _cells_to_visit(model: NeighbourModel, k: int):
    """Cells other than the own one that may hold a row as near as the k-th found, or as near as k rows are for sure, by part of the queries."""
    centres, radius, sizes = model.pivots, model.radius, model.rows
    live = radius >= 0

    def keep(values: np.ndarray, own: np.ndarray, limit: np.ndarray) -> np.ndarray:
        d, rows = _distances(values, centres), np.arange(len(values))
        far = np.where(live, d + radius, np.inf)
        order = np.argsort(far, axis=1)
        enough = (np.cumsum(sizes[order], axis=1) >= k).argmax(axis=1)
        sure = far[rows, order[rows, enough]] if sizes.sum() >= k else np.full(len(d), np.inf)
        bound = np.fmin(limit, sure) * (1 + 1e-9) + 1e-9
        found = live[None, :] & (d - radius[None, :] <= bound[:, None])
        gap = _distances(centres[own], centres)
        with np.errstate(divide="ignore", invalid="ignore"):
            beyond = (d ** 2 - (d[rows, own] ** 2)[:, None]) / (2 * gap)
        found &= ~((gap > 0) & (beyond > bound[:, None]))
        found[rows, own] = False
        return found

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                part, limit = batch.column("_part").to_numpy(), batch.column("_limit").to_numpy(zero_copy_only=False).astype(float)
                found = keep(_rows(batch.column("_x")), batch.column("_cell").to_numpy(), limit)
                for p in np.unique(part):
                    cells = np.flatnonzero(found[part == p].any(axis=0))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), p, "int32")), pa.array(cells.astype("int32"))], names=["_part", "_cell"])

    return visit


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def _codes(ids: np.ndarray) -> np.ndarray:
    """Numbers in the order of the ids, NULL first."""
    if ids.dtype != object:
        return ids
    place = {v: i for i, v in enumerate(sorted(set(ids), key=lambda v: (v is not None, v)))}
    return np.array([place[v] for v in ids], dtype="int64")


class _Part:
    """The queries of a part and the nearest rows of other cells that they have met."""

    def __init__(self, k: int):
        self.k, self.asked, self.distance = k, [], None

    def ask(self, batch: pa.RecordBatch) -> None:
        self.asked.append(batch.select(["_qid", "_cell", "_x", "_limit"]))

    def _begin(self) -> None:
        table = pa.Table.from_batches(self.asked).combine_chunks()
        self.asked, self.ids = [], table["_qid"]
        self.cell, self.x = table["_cell"].to_numpy(), _rows(table["_x"].combine_chunks())
        limit = table["_limit"].to_numpy().astype(float)
        self.bound = np.where(np.isnan(limit), np.inf, limit)
        self.own = (self.x * self.x).sum(1)
        self.wide = np.column_stack([-2.0 * self.x, np.ones(len(self.x)), self.own])
        self.distance = np.full((len(self.x), self.k), np.inf)
        self.near = self.label = None

    def meet(self, batch: pa.RecordBatch) -> None:
        if self.distance is None:
            self._begin()
        ids, labels = (batch.column(c).to_pandas(integer_object_nulls=True).to_numpy() for c in ("_id", "_label"))
        cell, t = batch.column("_cell").to_numpy(), _rows(batch.column("_x"))
        if self.near is None:
            self.near, self.label = np.empty(self.distance.shape, ids.dtype), np.empty(self.distance.shape, labels.dtype)
        if ids.dtype != self.near.dtype:
            self.near, ids = self.near.astype(object), ids.astype(object)
        if labels.dtype != self.label.dtype:
            self.label, labels = self.label.astype(object), labels.astype(object)
        size = (t * t).sum(1)
        wide = np.column_stack([t, size, np.ones(len(t))]).T
        step = max(1, SCREENED // len(t))
        for a in range(0, len(self.x), step):
            d2 = self.wide[a:a + step] @ wide
            edge = self.bound[a:a + step] ** 2
            open_ = np.flatnonzero(np.isinf(edge))
            if len(open_) and len(t) > self.k:  # k rows of this batch are as near
                edge[open_] = np.partition(d2[open_], self.k - 1, axis=1)[:, self.k - 1]
            edge += 1e-9 * (self.own[a:a + step] + size.max() + 1.0)
            i, j = np.nonzero(d2 <= edge[:, None])
            i += a
            other = self.cell[i] != cell[j]  # the own cell has been searched
            i, j = i[other], j[other]
            for at in range(0, len(i), CANDIDATES):
                some, to = i[at:at + CANDIDATES], j[at:at + CANDIDATES]
                exact = np.sqrt(((t[to] - self.x[some]) ** 2).sum(axis=1))
                nearer = exact <= self.bound[some]
                if nearer.any():
                    self._merge(some[nearer], ids[to[nearer]], labels[to[nearer]], exact[nearer])

    def _merge(self, i: np.ndarray, ids: np.ndarray, labels: np.ndarray, exact: np.ndarray) -> None:
        """Of the rows known and the new ones keep the k nearest of each query, of equal distances the first ids."""
        some, row = np.unique(i, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(some)), self.k), row])
        d = np.concatenate([self.distance[some].ravel(), exact])
        ids, labels = np.concatenate([self.near[some].ravel(), ids]), np.concatenate([self.label[some].ravel(), labels])
        order = np.lexsort((_codes(ids), d, row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        order, place = order[place < self.k], place[place < self.k]
        at = some[row[order]], place
        self.distance[at], self.near[at], self.label[at] = d[order], ids[order], labels[order]
        self.bound[some] = np.minimum(self.bound[some], self.distance[some, -1])

    def found(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.distance is None:
            return
        query, place = np.nonzero(np.isfinite(self.distance))
        for a in range(0, len(query), CANDIDATES):
            at = query[a:a + CANDIDATES], place[a:a + CANDIDATES]
            ids = self.ids.take(pa.array(at[0])).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array(self.near[at], schema.field("_id").type), pa.array(self.label[at], schema.field("_label").type),
                                              pa.array(self.distance[at])], names=["_qid", "_id", "_label", "distance"])


def _part_search(k: int):
    """The k nearest rows of other cells for the queries of each part, which come before the rows that it needs."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number, schema = None, None, None
        for batch in batches:
            schema = batch.schema
            part, side = batch.column("_part").to_numpy(), batch.column("_side").to_numpy()
            marks = np.flatnonzero(np.diff(part * 2 + side)) + 1
            for a, b in zip([0, *marks], [*marks, len(part)]):
                if a == b:
                    continue
                if side[a] == 0:
                    if number != part[a]:
                        if held is not None:
                            yield from held.found(schema)
                        held, number = _Part(k), part[a]
                    held.ask(batch.slice(a, b - a))
                elif number == part[a]:
                    held.meet(batch.slice(a, b - a))
        if held is not None:
            yield from held.found(schema)
    return search


def _parts(model: NeighbourModel, loads: dict[int, int], tasks: int) -> tuple[list[int], list[int], int]:
    """The first part of each cell, how many parts it has, and the number of parts: cells in a chain of near pivots share a part
    as long as their queries are few, and a cell with many is cut."""
    most = min(2 * model.block, max(LEAST_PART, math.ceil(sum(loads.values()) / tasks)))
    first, many, number, held = [0] * len(model.pivots), [1] * len(model.pivots), 0, 0
    left, at = np.ones(len(model.pivots), dtype=bool), 0
    for _ in range(len(model.pivots)):
        left[at] = False
        n = loads.get(at, 0)
        if held and held + n > most:
            number, held = number + 1, 0
        first[at], many[at] = number, max(1, math.ceil(n / most))
        held += n
        if many[at] > 1:
            number, held = number + many[at], 0
        if left.any():
            d = ((model.pivots - model.pivots[at]) ** 2).sum(1)
            at = int(np.where(left, d, np.inf).argmin())
    return first, many, number + 1


def _beyond(model: NeighbourModel, asked: DataFrame, k: int) -> DataFrame:
    """(_qid, _id, _label, distance): for each query (_qid, _x, _cell, _limit) the k nearest rows of other cells within its limit.

    A row is sent once to each part of the queries that needs its cell, and a task holds one part, so what is shuffled is the
    rows times the parts, and a part has as many queries as a task can hold.
    """
    spark = asked.sparkSession
    loads = {r["_cell"]: r["count"] for r in asked.groupBy("_cell").count().collect()}
    first, many, number = _parts(model, loads, 2 * spark.sparkContext.defaultParallelism)
    part = F.get(F.lit(first), F.col("_cell")) + F.pmod(F.xxhash64("_qid"), F.get(F.lit(many), F.col("_cell"))).cast("int")
    planned = materialise(asked.withColumn("_part", part), "planned")
    pairs = materialise(planned.select("_part", "_cell", "_x", "_limit").mapInArrow(_cells_to_visit(model, k), "_part int, _cell int").distinct(), "pairs")
    kinds = dict(model.table.dtypes) | {"_qid": dict(asked.dtypes)["_qid"]}
    empty = lambda c, kind: F.lit(None).cast(kind).alias(c)
    queries = planned.select("_part", F.lit(0).alias("_side"), "_cell", "_qid", "_x", "_limit", empty("_id", kinds["_id"]), empty("_label", kinds["_label"]))
    rows = lookup(model.table, pairs, ["_cell"], "inner").select("_part", F.lit(1).alias("_side"), "_cell", empty("_qid", kinds["_qid"]), "_x", empty("_limit", "double"), "_id", "_label")
    dealt = queries.unionByName(rows).repartitionById(number, F.col("_part")).sortWithinPartitions("_part", "_side")
    return dealt.mapInArrow(_part_search(k), f"_qid {kinds['_qid']}, _id {kinds['_id']}, _label {kinds['_label']}, distance double")


def _block_search(k: int):
    """The k nearest rows of a block for each query of it: screened by products, decided by exact distances."""
    def search(keys: tuple, train: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(train) or not len(asked):
            return pd.DataFrame({"_qid": [], "_id": [], "_label": [], "distance": []})
        by_id = train.sort_values("_id", kind="stable")
        ids, labels = by_id["_id"].to_numpy(), by_id["_label"].to_numpy()
        t, q, qid = _matrix(by_id["_x"]), _matrix(asked["_x"]), asked["_qid"].to_numpy()
        size = (t * t).sum(1)
        rows = max(1, 4_000_000 // len(t))
        out = []
        for start in range(0, len(q), rows):
            part = q[start:start + rows]
            own = (part * part).sum(1)
            d2 = size[None, :] + own[:, None] - 2.0 * (part @ t.T)
            edge = np.partition(d2, k - 1, axis=1)[:, k - 1] if len(t) > k else np.full(len(part), np.inf)
            # Many rows can be as near as the k-th one; of those at one exact distance only the first by id count.
            for a in range(0, len(part), max(1, 2_000_000 // len(t))):
                b = min(a + max(1, 2_000_000 // len(t)), len(part))
                i, j = np.nonzero(d2[a:b] <= (edge[a:b] + 1e-9 * (own[a:b] + size.max() + 1.0))[:, None])
                exact = np.sqrt(((t[j] - part[a + i]) ** 2).sum(axis=1))
                order = np.lexsort((j, exact, i))
                i, j, exact = i[order], j[order], exact[order]
                first = np.arange(len(i)) - np.searchsorted(i, i) < k
                out.append(pd.DataFrame({"_qid": qid[start + a + i[first]], "_id": ids[j[first]], "_label": labels[j[first]],
                                         "distance": exact[first]}))
        return pd.concat(out, ignore_index=True)
    return search


def _matched(table: DataFrame, visits: DataFrame, keys: Sequence[str], k: int, block: int) -> DataFrame:
    """(_qid, _id, _label, distance): the k nearest rows of every block that a query visits.

    A bucket (`keys`) of many rows is cut into slices that each of its queries visits, and its queries into parts; how many is
    counted first, so a hot bucket is spread over as many tasks as it has blocks.
    """
    keys = list(keys)
    loads = visits.groupBy(*keys).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block)).cast("long").alias("_parts"))
    sizes = table.groupBy(*keys).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block)).cast("long").alias("_slices"))
    plan = materialise(sizes.join(loads, keys), "buckets")
    rows = plan.count()
    each = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    left = lookup(table, plan, keys, "inner", rows).withColumn("_slice", F.pmod(F.xxhash64("_id"), F.col("_slices"))).withColumn(
        "_part", F.explode(each(F.col("_parts")))).drop("_parts", "_slices")
    right = lookup(visits, plan, keys, "inner", rows).withColumn("_part", F.pmod(F.xxhash64("_qid"), F.col("_parts"))).withColumn(
        "_slice", F.explode(each(F.col("_slices")))).drop("_parts", "_slices")
    kinds = dict(table.dtypes)
    schema = f"_qid {dict(visits.dtypes)['_qid']}, _id {kinds['_id']}, _label {kinds['_label']}, distance double"
    blocks = [*keys, "_slice", "_part"]
    return left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInPandas(_block_search(k), schema)


def _ranked(found: DataFrame, id: str, k: int) -> DataFrame:
    w = Window.partitionBy("_qid").orderBy("distance", "_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("_qid").alias(id), "rank", F.col("_id").alias("neighbour"), F.col("_label").alias("label"), "distance"))


def neighbours(model: NeighbourModel, queries: DataFrame, id: str, x: str, k: int | None = None) -> DataFrame:
    """(id, rank, neighbour, label, distance) of the `k` nearest training rows; equal distances in id order.

    The own cell is searched first; then only cells that reach within the k-th distance found.
    """
    k = k or model.k
    if k > model.k:
        raise ValueError(f"fitted for at most {model.k} neighbours")
    asked = queries.select(F.col(id).alias("_qid"), _vector(queries, x))
    asked = materialise(asked.withColumn("_cell", _nearest_pivot(model.pivots)("_x")["cell"]), "asked")
    first = materialise(_matched(model.table, asked, ["_cell"], k, model.block), "found")
    # A query has at most k rows from each slice of its cell.
    limit = first.groupBy("_qid").agg(F.array_sort(F.collect_list("distance")).alias("_d")).select(
        "_qid", F.when(F.size("_d") >= k, F.element_at("_d", k)).alias("_limit"))
    return _ranked(first.unionByName(_beyond(model, asked.join(limit, "_qid", "left"), k)), id, k)


@dataclass(frozen=True)
class HashTables:
    """Training rows (id, x, label, table, bucket), the planes (tables, bits, columns) and the point they pass through."""

    table: DataFrame
    planes: np.ndarray
    centre: np.ndarray
    block: int


def _keys(values: np.ndarray, planes: np.ndarray, centre: np.ndarray, probes: int) -> np.ndarray:
    """(rows, tables, probes): the buckets of each row, the own one first, then those beyond the planes that are nearest.

    Sets of planes to cross are tried in the order of their summed squared distances.
    """
    tables, bits, _ = planes.shape
    side = (values - centre) @ planes.reshape(tables * bits, -1).T
    side = side.reshape(len(values), tables, bits)
    own = ((side > 0) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
    if probes == 1:
        return own[:, :, None]
    near = np.argsort(np.abs(side), axis=2)[:, :, :min(bits, 6)]
    cost = np.take_along_axis(side, near, axis=2) ** 2
    sets = [s for r in range(1, 4) for s in itertools.combinations(range(near.shape[2]), r)]
    costs = np.stack([cost[:, :, list(s)].sum(axis=2) for s in sets], axis=2)
    flips = np.stack([(np.int64(1) << near[:, :, list(s)]).sum(axis=2) for s in sets], axis=2)
    best = np.argsort(costs, axis=2, kind="stable")[:, :, :probes - 1]
    return np.concatenate([own[:, :, None], own[:, :, None] ^ np.take_along_axis(flips, best, axis=2)], axis=2)


def _buckets(planes: np.ndarray, centre: np.ndarray, probes: int):
    @F.pandas_udf("array<struct<table:int,bucket:long>>")
    def buckets(values: pd.Series) -> pd.Series:
        out = []
        for a in range(0, len(values), 2048):
            for row in _keys(_matrix(values.iloc[a:a + 2048]), planes, centre, probes):
                out.append([{"table": t, "bucket": int(b)} for t, found in enumerate(row) for b in found])
        return pd.Series(out, dtype=object)
    return buckets


def fit_hash_tables(train: DataFrame, id: str, x: str, label: str, tables: int = HASH_TABLES, bits: int | None = None,
                    block: int = BLOCK_ROWS, seed: int = 0) -> HashTables:
    """Write every training row once into each of `tables` tables, under the signs of `bits` random projections.

    Planes pass through the mean; the bits grow with the logarithm of the rows, so buckets keep their size. Equal rows share
    all buckets, which are cut into blocks when they are searched.
    """
    rows = train.select(F.col(id).alias("_id"), F.col(x).cast("array<double>").alias("_x"), F.col(label).alias("_label"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_x")).alias("width")).first()
    if not facts["n"]:
        raise ValueError("no training rows")
    mean = rows.select(F.posexplode("_x").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("v")).orderBy("at").collect()
    centre = np.array([r["v"] for r in mean])
    bits = bits or max(1, min(40, math.ceil(math.log2(max(1, facts["n"] / BUCKET_ROWS)))))
    planes = np.random.default_rng(seed).normal(size=(tables, bits, facts["width"]))
    placed = rows.withColumn("_b", F.explode(_buckets(planes, centre, 1)("_x")))
    placed = placed.select("_id", "_x", "_label", F.col("_b.table").alias("_table"), F.col("_b.bucket").alias("_bucket"))
    return HashTables(materialise(placed, "tables"), planes, centre, block)


def approximate_neighbours(model: HashTables, queries: DataFrame, id: str, x: str, k: int = K, probes: int = HASH_PROBES) -> DataFrame:
    """(id, rank, neighbour, label, distance) of the `k` nearest rows among those that share a visited bucket with a query.

    Distances are exact; a neighbour that shares none of the visited buckets is missed, so a query may have fewer than `k`.
    More probes or tables find more.
    """
    asked = queries.select(F.col(id).alias("_qid"), F.col(x).cast("array<double>").alias("_x"))
    visits = asked.withColumn("_b", F.explode(_buckets(model.planes, model.centre, probes)("_x"))).select(
        "_qid", "_x", F.col("_b.table").alias("_table"), F.col("_b.bucket").alias("_bucket"))
    found = _matched(model.table, materialise(visits, "visits"), ["_table", "_bucket"], k, model.block)
    return _ranked(found.dropDuplicates(["_qid", "_id"]), id, k)


def recall(found: DataFrame, exact: DataFrame, id: str) -> DataFrame:
    """n_wanted and recall: the share of exact neighbours that were found, where one as near as the last exact one counts."""
    last = exact.groupBy(id).agg(F.max("distance").alias("_last"), F.count(F.lit(1)).alias("_n"))
    got = found.join(last, id).filter(F.col("distance") <= F.col("_last")).groupBy(id).agg(F.count(F.lit(1)).alias("_got"))
    both = last.join(got, id, "left").agg(F.sum("_n").alias("n_wanted"), F.sum(F.least("_n", F.coalesce("_got", F.lit(0)))).alias("_found"))
    return both.select("n_wanted", (F.col("_found") / F.col("n_wanted")).alias("recall"))


def leave_one_out(train: DataFrame, id: str, x: str, label: str, k: int = K, **options) -> DataFrame:
    """Neighbours of each training row among all others."""
    model = fit_neighbours(train, id, x, label, k + 1, **options)
    found = neighbours(model, train, id, x).filter(F.col(id) != F.col("neighbour"))
    w = Window.partitionBy(id).orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _weight(weights: str) -> Column:
    """1, or 1 / distance; a query that hits training rows exactly counts only those."""
    if weights == "uniform":
        return F.lit(1.0)
    hits = F.min("distance").over(Window.partitionBy("_key")) == 0
    return F.when(hits, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("distance")))


def classify(found: DataFrame, id: str, weights: str = "uniform", out: str = "y_pred") -> DataFrame:
    """Class with the largest summed weight; the smallest class of a tie."""
    votes = found.withColumn("_key", F.col(id)).withColumn("_w", _weight(weights)).groupBy(id, "label").agg(F.sum("_w").alias("_w"))
    return votes.groupBy(id).agg(F.max_by(F.col("label"), F.struct("_w", -F.col("label"))).alias(out))


def regress(found: DataFrame, id: str, weights: str = "uniform", out: str = "y_pred") -> DataFrame:
    """Weighted mean label of the neighbours."""
    weighted = found.withColumn("_key", F.col(id)).withColumn("_w", _weight(weights))
    return weighted.groupBy(id).agg((F.sum(F.col("_w") * F.col("label")) / F.sum("_w")).alias(out))
