"""Exact quantiles with linear interpolation, whatever the number of rows.

Up to `direct_rows` rows a column is sorted in one task. Beyond, a pass of approximate percentiles brackets the
wanted ranks, a counting pass tells which bracket holds each rank, and this repeats until the brackets hold few rows;
only those are sorted. All columns and quantiles share each pass.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIRECT_ROWS = 1_000_000
WINDOW_ROWS = 100_000
ACCURACY = 10_000
SLACK = 0.0005
PARALLEL_COLUMNS = 8
# Items that a quantile sketch keeps at its finest level.
SKETCH_SIZE = 800

Rank = tuple[str, int]
Range = tuple[str, float, float, int, int]


def exact_quantiles(df: DataFrame, cols: Sequence[str], shares: Sequence[float],
                    direct_rows: int = DIRECT_ROWS, window_rows: int = WINDOW_ROWS) -> dict[str, list[float | None]]:
    """Quantiles of each column; NULLs are left out."""
    cols = list(cols)
    facts = df.agg(*[f(c).alias(f"{c}_{i}") for c in cols for i, f in enumerate((F.count, F.min, F.max))]).first()
    sizes = {c: facts[f"{c}_0"] for c in cols}
    small = [c for c in cols if sizes[c] <= direct_rows]
    out: dict[str, list[float | None]] = {}
    if small:
        def direct(c: str) -> list[float | None]:
            n = sizes[c]
            if not n:
                return [None] * len(shares)
            ranks = sorted({r for s in shares for r in _ranks(s, n)})
            place = F.row_number().over(Window.orderBy("v")) - 1
            rows = (df.select(F.col(c).cast("double").alias("v")).filter(F.col("v").isNotNull())
                    .withColumn("r", place).filter(F.col("r").isin(ranks)).collect())
            values = {(c, r["r"]): r["v"] for r in rows}
            return [_interpolate(values, c, s, n) for s in shares]
        # A small column is sorted in one task, so columns run side by side.
        with ThreadPoolExecutor(min(len(small), PARALLEL_COLUMNS)) as pool:
            out.update(zip(small, pool.map(direct, small)))
    large = [c for c in cols if c not in out]
    if large:
        whole = {c: (c, float(facts[f"{c}_1"]), float(facts[f"{c}_2"]), 0, sizes[c]) for c in large}
        ranks = {(c, r): whole[c] for c in large for s in shares for r in _ranks(s, sizes[c])}
        values = _order_statistics(df, ranks, window_rows)
        for c in large:
            out[c] = [_interpolate(values, c, s, sizes[c]) for s in shares]
    return out


def _ranks(share: float, n: int) -> tuple[int, int]:
    at = share * (n - 1)
    return math.floor(at), math.ceil(at)


def _interpolate(values: dict[Rank, float], c: str, share: float, n: int) -> float:
    lo, hi = _ranks(share, n)
    at = share * (n - 1)
    return values[c, lo] if lo == hi else values[c, lo] * (hi - at) + values[c, hi] * (at - lo)


def _order_statistics(df: DataFrame, ranks: dict[Rank, Range], window_rows: int) -> dict[Rank, float]:
    """Exact values at 0-based ranks. A range is (column, low, high, rows below low, rows inside)."""
    found: dict[Rank, float] = {}
    ranks = dict(ranks)
    while True:
        found.update({k: r[1] for k, r in ranks.items() if r[1] == r[2]})
        ranks = {k: r for k, r in ranks.items() if k not in found}
        wide = defaultdict(list)
        for key, r in ranks.items():
            if r[4] > window_rows:
                wide[r].append(key)
        if not wide:
            break
        _narrow(df, wide, ranks, found)
    if ranks:
        found.update(_read_ranges(df, ranks))
    return found


def _inside(r: Range) -> Column:
    return F.col(r[0]).between(r[1], r[2])


def _narrow(df: DataFrame, wide: dict[Range, list[Rank]], ranks: dict[Rank, Range], found: dict[Rank, float]) -> None:
    """One approximate pass for cut values around the ranks, one exact pass for the rows at and between the cuts."""
    spans = list(wide)
    asked = []
    for r in spans:
        at = sorted({(rank - r[3] + 0.5) / r[4] for _, rank in wide[r]})
        shares = [min(max(a + d, 0.0), 1.0) for a in at for d in (-SLACK, SLACK)]
        value = F.col(r[0]).cast("double") if r[3] == 0 and len(spans) == 1 else F.when(_inside(r), F.col(r[0]).cast("double"))
        asked.append(F.percentile_approx(value, shares, ACCURACY))
    row = df.agg(*[a.alias(str(i)) for i, a in enumerate(asked)]).first()
    cuts = [sorted(set(row[str(i)])) for i in range(len(spans))]
    # Zone 2j lies below cut j, zone 2j + 1 is the cut itself. A search in the sorted edges finds the zone of a value.
    values = df.select(*[F.when(_inside(r), F.col(r[0]).cast("double")).alias(f"v{i}") for i, r in enumerate(spans)])
    # Cuts may be neighbouring numbers, or infinite; each edge stands once, and infinite values have buckets of their own.
    edges = [sorted({-math.inf, math.inf, *[e for c in cut for e in (c, math.nextafter(c, math.inf))]}) for cut in cuts]
    names = [f"z{i}" for i in range(len(spans))]
    zoned = Bucketizer(splitsArray=edges, inputCols=[f"v{i}" for i in range(len(spans))], outputCols=names,
                       handleInvalid="keep").transform(values)
    cells = F.array(*[F.struct(F.lit(i).alias("span"), F.when(F.col(f"v{i}") == math.inf, F.lit(len(edges[i]))).when(F.col(f"v{i}") == -math.inf, F.lit(-1))
                               .when(F.col(f"v{i}").isNotNull(), F.col(n)).cast("int").alias("bucket")) for i, n in enumerate(names)])
    counted = zoned.select(F.inline(cells)).filter(F.col("bucket").isNotNull()).groupBy("span", "bucket").agg(
        F.count(F.lit(1)).alias("n"))
    rows: dict[tuple[int, int], int] = defaultdict(int)
    for c in counted.collect():
        edge, cut = [*edges[c["span"]][:-1], math.nan, math.inf, -math.inf][c["bucket"]], cuts[c["span"]]
        if edge == edge:  # NaN has the bucket after the last
            rows[c["span"], 2 * bisect_left(cut, edge) + (edge in cut)] += c["n"]
    for i, r in enumerate(spans):
        c, lo, hi, below, _ = r
        for zone in range(2 * len(cuts[i]) + 1):
            n = rows.get((i, zone), 0)
            for key in wide[r]:
                if below <= key[1] < below + n:
                    if zone % 2:
                        found[key] = cuts[i][zone // 2]
                    else:
                        j = zone // 2
                        low = lo if j == 0 else math.nextafter(cuts[i][j - 1], math.inf)
                        high = hi if j == len(cuts[i]) else math.nextafter(cuts[i][j], -math.inf)
                        ranks[key] = (c, low, high, below, n)
            below += n


def _read_ranges(df: DataFrame, ranks: dict[Rank, Range]) -> dict[Rank, float]:
    """Sort the distinct values of all remaining ranges, in one scan, and read the wanted ranks."""
    spans = sorted(set(ranks.values()))
    any_hit = _inside(spans[0])
    for r in spans[1:]:
        any_hit = any_hit | _inside(r)
    cells = F.array(*[F.struct(F.lit(i).alias("span"), F.when(_inside(r), F.col(r[0]).cast("double")).alias("v"))
                      for i, r in enumerate(spans)])
    hits = df.filter(any_hit).select(F.inline(cells)).filter(F.col("v").isNotNull())
    counted = hits.groupBy("span", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("span").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = counted.withColumn("_to", F.sum("n").over(w))
    keys = list(ranks)
    wants = [F.min(F.when((F.col("span") == spans.index(ranks[k])) & (F.col("_to") > k[1] - ranks[k][3]), F.col("v"))).alias(str(i))
             for i, k in enumerate(keys)]
    row = run.agg(*wants).first()
    return {k: row[str(i)] for i, k in enumerate(keys)}


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """(by, column_name, sketch): a mergeable sketch of each column, for each group of `by` (a day, a file, a series).

    A sketch has a fixed size; kept as a table, groups can be merged later without reading the rows again. The ranks of its
    quantiles are off by some 2 / size of the rows at most.
    """
    # Without `by` one row; columns are aggregated side by side and only sketches are turned into rows.
    made = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"_s{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(cols)]
    return made.select(*by, F.inline(F.array(*cells)))


def merged_quantiles(sketches: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, n, values): quantiles of merged sketches, in the order of `shares`; NULL for a column without values."""
    merged = sketches.groupBy(*by, "column_name").agg(F.kll_merge_agg_double("sketch").alias("_s"))
    n = F.kll_sketch_get_n_double("_s")
    return merged.select(*by, "column_name", n.alias("n"), F.when(n > 0, F.array(*[F.kll_sketch_get_quantile_double("_s", F.lit(float(s))) for s in shares])).alias("values"))


def sketched_quantiles(df: DataFrame, cols: Sequence[str], shares: Sequence[float], size: int = SKETCH_SIZE) -> dict[str, list[float | None]]:
    """Quantiles of each column from one pass, off by some 2 / size of the rows at most; NULLs are left out."""
    found = merged_quantiles(quantile_sketches(df, cols, size=size), shares).collect()
    return {r["column_name"]: list(r["values"]) if r["n"] else [None] * len(shares) for r in found}
