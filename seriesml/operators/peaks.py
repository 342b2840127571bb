"""Local maxima with a minimum distance, and the frequency of peaks.

A run of equal values counts as one sample, placed at its middle. Among peaks closer than `distance` the higher one
wins, and of equal ones the later. Peaks influence each other only within a cluster of close candidates, so clusters
are settled on their own: small ones by an array expression, large ones in blocks whose borders are settled by one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesml.functions.rolling import PEAK_SCALE, rolling_mean
from seriesml.operators.ordering import (
    SeriesLayout, carry_forward, dense_index, join_on, neighbours, over_series, settled)
from seriesml.session import materialise

PEAK_DISTANCE = 5
SMALL_CLUSTER = 512
OPEN_BLOCK = 200_000


def peak_candidates(indexed: DataFrame, layout: SeriesLayout, col: str, index: str = "_i") -> DataFrame:
    """Strict local maxima of an indexed table: series, `pos` (middle of the run) and `height`. Ends never count."""
    rows = indexed.select(*layout.series, F.col(index).alias("_at"), F.col(col).alias("height"))
    rows = neighbours(rows, layout, "_at", ["height"])
    starts = rows.filter(F.col("_prev").isNull() | ~F.col("_prev.height").eqNullSafe(F.col("height")))
    starts = settled(starts.select(*layout.series, "_at", "height"), layout, "runs")
    runs = neighbours(starts, layout, "_at", ["_at", "height"])
    return (runs.filter((F.col("_prev.height") < F.col("height")) & (F.col("_next.height") < F.col("height")))
            .select(*layout.series,
                    F.floor((F.col("_at") + F.col("_next._at") - 1) / 2).cast("long").alias("pos"), "height"))


def _greedy(members: Column, distance: int) -> Column:
    """Kept positions of a small cluster given as array<struct<height, pos>>."""
    return F.aggregate(
        F.sort_array(members, asc=False),
        F.array().cast("array<bigint>"),
        lambda kept, m: F.when(F.exists(kept, lambda k: F.abs(k - m["pos"]) < distance), kept)
        .otherwise(F.array_append(kept, m["pos"])))


def _kept(pos: np.ndarray, height: np.ndarray, distance: int, outside: Sequence[tuple[int, float]]) -> np.ndarray:
    """Which candidates of a block stay, highest first, when `outside` are the kept ones next to the block.

    A candidate goes when a kept one that is higher (of equal height, later) is closer than `distance`.
    """
    n = len(pos)
    kept = np.zeros(n, dtype=bool)
    gone = np.zeros(n, dtype=bool)
    for p, h in outside:
        near = np.arange(np.searchsorted(pos, p - distance, side="right"), np.searchsorted(pos, p + distance, side="left"))
        gone[near[(height[near] < h) | ((height[near] == h) & (pos[near] < p))]] = True
    left = np.searchsorted(pos, pos - distance, side="right")
    right = np.searchsorted(pos, pos + distance, side="left")
    for j in np.lexsort((-pos, -height)).tolist():
        if not gone[j]:
            gone[left[j]:right[j]] = True  # all others near are lower or gone already
            kept[j] = True
    return kept


def _border_map(pos: np.ndarray, height: np.ndarray, side: np.ndarray, distance: int, lo: int, hi: int) -> list[dict]:
    """What a block shows its neighbours for everything they may show it.

    `side` is -1, 0, 1 for candidates before, in and after the block. Of the candidates near a border at most one is kept,
    so what a side shows is one position or nothing (NULL). Rows: before, after (shown to the block), first, last (shown by it).
    """
    own = side == 0
    p, h = pos[own], height[own]
    choices = [[None, *zip(pos[side == s].tolist(), height[side == s].tolist())] for s in (-1, 1)]
    out = []
    for before in choices[0]:
        for after in choices[1]:
            kept = p[_kept(p, h, distance, [x for x in (before, after) if x is not None])]
            shown = {"first": int(kept[0]) if len(kept) and kept[0] < lo + distance - 1 else None,
                     "last": int(kept[-1]) if len(kept) and kept[-1] > hi - distance + 1 else None}
            out.append({"before": before and int(before[0]), "after": after and int(after[0]), **shown})
    return out


def _scanned(maps: list[dict[tuple, tuple]]) -> list[tuple]:
    """What each block of a cluster is shown (before, after), from the maps of its blocks in order.

    Forward, the blocks up to one are a map from what the next one shows to what they show it; backward, the end of the
    cluster shows nothing, and each map in turn says what its own blocks showed. Heights decide in one order, so there is
    exactly one consistent choice at each border.
    """
    prefix: list[dict] = []  # for each block: from what the next one shows to what it shows the next one

    def agrees(before, first) -> bool:
        if not prefix_of:
            return before is None
        return first in prefix_of[-1] and prefix_of[-1][first] == before

    for table in maps:
        prefix_of = prefix[-1:]
        prefix.append({after: last for (before, after), (first, last) in table.items() if agrees(before, first)})
    out, after = [], None
    for i in range(len(maps) - 1, -1, -1):
        prefix_of = prefix[i - 1:i] if i else []
        before = next(b for (b, a), (first, _) in maps[i].items() if a == after and agrees(b, first))
        out.append((before, after))
        after = maps[i][before, after][0]
    return out[::-1]


def _large_clusters(members: DataFrame, series: Sequence[str], distance: int, block: int) -> DataFrame:
    """Kept positions of clusters of any size, in a fixed number of jobs.

    Clusters are cut into blocks of positions. A block sees the candidates next to its borders as well and gives its map from
    what may be kept there to what it then keeps next to them; these maps, one for each block, are scanned in order; then every
    block is settled with what its neighbours really keep. A map has a row for each pair of candidates near its two borders, some
    (distance / 2) squared.
    """
    block = max(block, 4 * distance)
    keys = [*series, "_cluster"]
    pos, part = F.col("pos"), F.floor(F.col("pos") / block)
    near = F.array_compact(F.array(
        F.struct(part.alias("part"), F.lit(0).alias("side")),
        F.when(pos - part * block < distance - 1, F.struct((part - 1).alias("part"), F.lit(1).alias("side"))),
        F.when((part + 1) * block - 1 - pos < distance - 1, F.struct((part + 1).alias("part"), F.lit(-1).alias("side")))))
    spread = members.select(*keys, "pos", F.col("height").cast("double").alias("height"), F.explode(near).alias("_n"))
    cells = F.sort_array(F.collect_list(F.struct("pos", "height", F.col("_n.side").alias("side"))))
    # A block without candidates of its own lies beyond the end of its cluster.
    blocks = spread.groupBy(*keys, F.col("_n.part").alias("_part")).agg(cells.alias("m")).filter(F.exists("m", lambda m: m["side"] == 0))
    blocks = materialise(blocks, "blocks")
    rows = "array<struct<before:bigint,after:bigint,first:bigint,last:bigint>>"

    @F.pandas_udf(rows)
    def mapped(pos: pd.Series, height: pd.Series, side: pd.Series, part: pd.Series) -> pd.Series:
        return pd.Series([_border_map(np.asarray(p), np.asarray(h), np.asarray(s), distance, n * block, (n + 1) * block - 1)
                          for p, h, s, n in zip(pos, height, side, part)], dtype=object)

    def scan(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_part")
        maps = [{(r["before"], r["after"]): (r["first"], r["last"]) for r in table} for table in pdf["_map"]]
        found = _scanned(maps)
        made = pdf.drop(columns="_map")
        for at, name in enumerate(("_before", "_after")):
            made[name] = pd.array([x[at] for x in found], dtype="Int64")
        return made

    m = F.col("m")
    maps = blocks.select(*keys, "_part", mapped(m["pos"], m["height"], m["side"], F.col("_part")).alias("_map"))
    kinds = dict(maps.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in (*keys, "_part")], "_before bigint", "_after bigint"])
    shown = maps.groupBy(*keys).applyInPandas(scan, schema)

    @F.pandas_udf("array<bigint>")
    def settle(pos: pd.Series, height: pd.Series, side: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
        out = []
        for p, h, s, b, a in zip(pos, height, side, before, after):
            p, h, own = np.asarray(p), np.asarray(h), np.asarray(s) == 0
            outside = [(x, h[(p == x)][0]) for x in (b, a) if not pd.isna(x)]
            out.append(p[own][_kept(p[own], h[own], distance, outside)])
        return pd.Series(out, dtype=object)

    both = join_on(blocks, shown, [*keys, "_part"], "inner")
    return both.select(*series, F.explode(settle(m["pos"], m["height"], m["side"], "_before", "_after")).alias("pos"))


def suppress_close(candidates: DataFrame, layout: SeriesLayout, distance: int = PEAK_DISTANCE,
                   small: int = SMALL_CLUSTER, block: int = OPEN_BLOCK) -> DataFrame:
    """Positions of the candidates that survive the minimum distance."""
    series = list(layout.series)
    near = neighbours(settled(candidates, layout, "candidates"), layout, "pos", ["pos"])
    near = near.withColumn(
        "_start", F.when(F.col("_prev").isNull() | (F.col("pos") - F.col("_prev.pos") >= distance), F.col("pos")))
    near = settled(near.drop("_prev", "_next"), layout, "candidates")
    # Read by the size check and by both kinds of clusters.
    marked = materialise(carry_forward(near, layout, "pos", "_start", "_cluster").drop("_start"), "clusters")
    keys = [*series, "_cluster"]
    sizes = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    big = sizes.filter(F.col("_size") > small).select(*keys)
    if big.isEmpty():
        return _small_clusters(marked, series, distance)
    large = join_on(marked, big, keys, "left_semi")
    rest = join_on(marked, big, keys, "left_anti")
    return _small_clusters(rest, series, distance).unionByName(_large_clusters(large, series, distance, block))


def _small_clusters(marked: DataFrame, series: Sequence[str], distance: int) -> DataFrame:
    grouped = marked.groupBy(*series, "_cluster").agg(F.collect_list(F.struct("height", "pos")).alias("_members"))
    return grouped.select(*series, F.explode(_greedy(F.col("_members"), distance)).alias("pos"))


def peak_positions(df: DataFrame, layout: SeriesLayout, col: str, distance: int = PEAK_DISTANCE) -> DataFrame:
    """Series and 0-based positions of the peaks of `col`."""
    indexed = settled(dense_index(df, layout).select(*layout.series, "_i", col), layout, "indexed")
    found = peak_candidates(indexed, layout, col)
    if distance <= 1:
        return found.select(*layout.series, "pos")
    return suppress_close(found, layout, distance)


def peak_flags(df: DataFrame, layout: SeriesLayout, col: str, out: str = "is_peak",
               distance: int = PEAK_DISTANCE) -> DataFrame:
    """Add a 0/1 peak flag to each row."""
    marks = peak_positions(df, layout, col, distance).withColumn(out, F.lit(1)).withColumnRenamed("pos", "_i")
    flagged = join_on(dense_index(df, layout), marks, [*layout.series, "_i"])
    return flagged.withColumn(out, F.coalesce(out, F.lit(0))).drop("_i")


def peak_frequency(df: DataFrame, layout: SeriesLayout, col: str, out: str, mean_length: int,
                   distance: int = PEAK_DISTANCE, rows: DataFrame | None = None) -> DataFrame:
    """Add the rolling mean of the peak frequency.

    At a peak the frequency is 10 over the number of other samples since the last peak (or the start of the
    series); it holds until the next peak and is 0 before the first. `rows` may be a written table with the same
    series, index `_i` and `col` as `df`; then `df` has the index too.
    """
    indexed = df if rows is not None and "_i" in df.columns else settled(dense_index(df, layout), layout, "indexed")
    narrow = (rows if rows is not None and "_i" in rows.columns else indexed).select(*layout.series, "_i", col)
    found = peak_candidates(narrow, layout, col)
    peaks = suppress_close(found, layout, distance) if distance > 1 else found.select(*layout.series, "pos")
    peaks = neighbours(settled(peaks, layout, "peaks"), layout, "pos", ["pos"])
    since = F.col("pos") - F.coalesce(F.col("_prev.pos"), F.lit(-1)) - 1
    marks = peaks.select(*layout.series, F.col("pos").alias("_i"), (F.lit(PEAK_SCALE) / since).alias("_mark"))
    marks = settled(marks, layout, "marks")
    keys = [*layout.series, "_i"]
    held = carry_forward(join_on(indexed, marks, keys), layout, "_i", "_mark", "_freq", join_on(narrow.drop(col), marks, keys))
    held = held.withColumn("_freq", F.coalesce("_freq", F.lit(0.0))).drop("_mark")
    made = over_series(held, layout, lambda w: [rolling_mean(F.col("_freq"), w, mean_length).alias(out)], mean_length - 1,
                       index="_i").drop("_freq")
    return made if "_i" in df.columns else made.drop("_i")
