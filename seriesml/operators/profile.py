"""Statistical profile of a table, as tidy tables with one row per column, pair of columns, value or alert."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesml.functions.columns import correlation, is_numeric, numeric_columns
from seriesml.functions.statistics import chi_squared_tail
from seriesml.operators.learners import with_vector
from seriesml.operators.ordering import cumulative_share, lookup
from seriesml.operators.quantiles import DIRECT_ROWS, exact_quantiles
from seriesml.session import materialise

# Fixed values of the profile configuration.
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
LOW_CATEGORICAL = 5
HISTOGRAM_BINS = 50
FREQUENCY_ROWS = 10
EXTREME_ROWS = 5
DUPLICATE_ROWS = 10
SAMPLE_ROWS = 10
CHI_SQUARED_THRESHOLD = 0.999
SKEWNESS_THRESHOLD = 20.0
CORRELATION_THRESHOLD = 0.9
BOOLEAN_PAIRS = (("t", "f"), ("yes", "no"), ("y", "n"), ("true", "false"))
# Columns per aggregate, so that generated code stays small for wide tables.
COLUMNS_PER_PASS = 50
PAIRS_PER_PASS = 40
# Up to this many columns distinct values are counted column by column inside one plan.
COLUMNS_APART = 32
# Above this many columns the correlations come from one matrix.
MATRIX_COLUMNS = 9


def _long(row: DataFrame, cols: Sequence[str], stats: Sequence[str], name: str = "column_name") -> DataFrame:
    """One row with `<column>__<stat>` columns to one row per column."""
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias(name), *[F.col(f"`{c}__{s}`").alias(s) for s in stats]) for c in cols])))


def _per_column(df: DataFrame, cols: Sequence[str], exprs: dict[str, callable]) -> DataFrame:
    """Aggregates `exprs[stat](column)` for all columns, in one pass per block of columns."""
    out = None
    for at in range(0, len(cols), COLUMNS_PER_PASS):
        block = cols[at:at + COLUMNS_PER_PASS]
        row = df.agg(*[f(c).alias(f"{c}__{s}") for c in block for s, f in exprs.items()])
        part = _long(row, block, list(exprs))
        out = part if out is None else out.unionByName(part)
    return out


def missing(c: str) -> Column:
    return F.col(c).isNull()


def _row_hashes(df: DataFrame) -> DataFrame:
    """`df` with two 64-bit hashes of its rows."""
    return df.withColumns({"_h1": F.xxhash64(*df.columns), "_h2": F.xxhash64(F.lit(1), *df.columns)})


def _hash_groups(df: DataFrame) -> DataFrame:
    """(_h1, _h2, _n) of the hashes that stand in several rows: 24 bytes a row are shuffled, however wide the rows are."""
    return _row_hashes(df).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)


def _rows_of(df: DataFrame, groups: DataFrame) -> DataFrame:
    """The distinct rows with these hashes and their numbers; whole rows are compared only here."""
    return lookup(_row_hashes(df), groups.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))


def overview(df: DataFrame) -> DataFrame:
    """Variables, rows, missing cells and duplicate rows (all copies beyond the first).

    Rows are counted by two hashes first, and whole rows only among repeated hashes, so a wide table is not shuffled.
    """
    gaps = sum((missing(c).cast("long") for c in df.columns), F.lit(0).cast("long"))
    facts = df.agg(F.lit(len(df.columns)).cast("long").alias("n_variables"), F.count(F.lit(1)).alias("n_rows"),
                   F.coalesce(F.sum(gaps), F.lit(0)).cast("long").alias("n_missing_cells"))
    groups = materialise(_hash_groups(df), "repeated")
    if groups.isEmpty():
        return facts.withColumn("n_duplicate_rows", F.lit(0).cast("long"))
    again = _rows_of(df, groups).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicate_rows")).first()
    return facts.withColumn("n_duplicate_rows", F.lit(again["n_duplicate_rows"]).cast("long"))


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column, and the non-NULL rows.

    Exact counts send each (column, value) pair once per map task; `approximate` keeps a fixed-size sketch instead.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    stats = {"n_distinct": count, "n": F.count}
    if approximate or len(cols) > COLUMNS_APART:
        return _per_column(df, list(cols), stats)
    # Few columns: one aggregate per column, each reading its own column, without copies of the rows per column.
    out = None
    for c in cols:
        part = _per_column(df.select(c), [c], stats)
        out = part if out is None else out.unionByName(part)
    return out


def distinct_flags(df: DataFrame, cols: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct count, its share of the rows, and the constant and unique flags."""
    cols = list(cols or df.columns)
    got = distinct_counts(df, cols, approximate)
    return got.select("column_name", "n_distinct", F.try_divide("n_distinct", "n").alias("p_distinct"),
                      (F.col("n_distinct") <= 1).alias("is_constant"),
                      ((F.col("n_distinct") == F.col("n")) & (F.col("n") > 0)).alias("is_unique"))


def column_types(df: DataFrame, low_categorical: int = LOW_CATEGORICAL, approximate: bool = False) -> DataFrame:
    """numeric / boolean / categorical / datetime.

    A numeric column with few distinct values is categorical, a text column holding one of the true/false pairs boolean.
    """
    def declared(kind: T.DataType) -> str:
        if isinstance(kind, T.BooleanType):
            return "boolean"
        if is_numeric(kind):
            return "numeric"
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "datetime"
        return "categorical"
    kinds = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, declared(f.dataType))])
    got = distinct_counts(df, df.columns, approximate).withColumn("_kind", kinds[F.col("column_name")])
    few = (F.col("_kind") == "numeric") & (F.col("n_distinct") < low_categorical)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    flags = [r["column_name"] for r in boolean_columns(df, texts).filter("is_boolean").collect()] if texts else []
    kind = F.when(F.col("column_name").isin(flags), "boolean").when(few, "categorical").otherwise(F.col("_kind"))
    return got.select("column_name", kind.alias("inferred_type"), "n_distinct")


def categorical_variables(df: DataFrame) -> list[str]:
    rows = column_types(df).filter(F.col("inferred_type") == "categorical").select("column_name").collect()
    names = {r[0] for r in rows}
    return [c for c in df.columns if c in names]


def boolean_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns whose values are one of the known true/false pairs, compared in lower case."""
    def fits(c: str) -> Column:
        values = F.collect_set(F.when(~F.lower(c).isin([v for p in BOOLEAN_PAIRS for v in p]), F.lit("other"))
                               .otherwise(F.lower(c)))
        pairs = [F.size(F.array_except(values, F.array(*[F.lit(v) for v in p]))) == 0 for p in BOOLEAN_PAIRS]
        any_pair = pairs[0]
        for p in pairs[1:]:
            any_pair = any_pair | p
        return (F.size(values) > 0) & any_pair
    return _per_column(df, list(cols), {"is_boolean": fits})


def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None, direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """Moments of each numeric column in one pass, and the median absolute deviation in a second.

    Skewness and kurtosis carry the small-sample correction; standard deviation and variance divide by n - 1.
    """
    cols = list(cols or numeric_columns(df))

    def skew(c: str) -> Column:
        n = F.count(c).cast("double")
        return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))

    def kurt(c: str) -> Column:
        n = F.count(c).cast("double")
        return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))

    stats = {
        "n": F.count, "mean": F.avg, "std": F.stddev_samp, "variance": F.var_samp,
        "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double"),
        "range": lambda c: (F.max(c) - F.min(c)).cast("double"), "sum": lambda c: F.sum(F.col(c).cast("double")),
        "skewness": skew, "kurtosis": kurt, "cv": lambda c: F.try_divide(F.stddev_samp(c), F.avg(c)),
    }
    medians = {c: q[0] for c, q in exact_quantiles(df, cols, [0.5], direct_rows).items()}
    away = df.select(*[F.abs(F.col(c) - F.lit(medians[c])).alias(c) for c in cols])
    mads = {c: q[0] for c, q in exact_quantiles(away, cols, [0.5], direct_rows).items()}
    lookup = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(mads[c]).cast("double"))])
    return _per_column(df, cols, stats).withColumn("mad", lookup[F.col("column_name")])


def quantile_summary(df: DataFrame, cols: Sequence[str] | None = None, shares: Sequence[float] = QUANTILES,
                     approximate: bool = False, direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """Quantiles as columns `q5`, `q25`, … and the interquartile range."""
    cols = list(cols or numeric_columns(df))
    if approximate:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(shares)).alias(c) for c in cols]).first()
        found = {c: list(row[c]) for c in cols}
    else:
        found = exact_quantiles(df, cols, shares, direct_rows)
    names = [f"q{round(s * 100):d}" for s in shares]
    rows = [(c, *found[c]) for c in cols]
    table = df.sparkSession.createDataFrame(rows, ", ".join(["column_name string", *[f"{n} double" for n in names]]))
    return table.withColumn("iqr", F.col("q75") - F.col("q25")) if {0.25, 0.75} <= set(shares) else table


def zero_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or numeric_columns(df))
    return _per_column(df, cols, {"n_zeros": lambda c: F.count_if(F.col(c) == 0),
                                  "p_zeros": lambda c: F.try_divide(F.count_if(F.col(c) == 0), F.count(F.lit(1)))})


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return _per_column(df, list(cols or df.columns), {
        "n_missing": lambda c: F.count_if(missing(c)),
        "p_missing": lambda c: F.try_divide(F.count_if(missing(c)), F.count(F.lit(1)))})


def column_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Whether a column has one value at most, and the share of zeros of numeric ones: one pass, nothing is shuffled.

    A column is constant when its least and its largest value are the same, so no distinct values are counted.
    """
    numeric = {c for c in cols if is_numeric(df.schema[c].dataType)}

    def zeros(c):
        return F.try_divide(F.count_if(F.col(c) == 0), F.count(F.lit(1))) if c in numeric else F.max(F.lit(None).cast("double"))
    return _per_column(df, list(cols), {"is_constant": lambda c: F.min(c).eqNullSafe(F.max(c)), "p_zeros": zeros})


def _pair_table(df: DataFrame, pairs: Sequence[tuple[str, str]], score: callable, name: str) -> DataFrame:
    out = None
    for at in range(0, len(pairs), PAIRS_PER_PASS):
        block = pairs[at:at + PAIRS_PER_PASS]
        row = df.agg(*[score(a, b).alias(f"_{i}") for i, (a, b) in enumerate(block)])
        part = row.select(F.inline(F.array(*[
            F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"_{i}").alias(name))
            for i, (a, b) in enumerate(block)])))
        out = part if out is None else out.unionByName(part)
    return out


def pearson(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair of columns (each pair once); NULL for a column that does not vary.

    A first pass finds columns that are constant or have gaps. Complete columns then share one pass, as a matrix when
    there are many; only pairs with gaps need sums of their own.
    """
    cols = list(cols or numeric_columns(df))
    facts = df.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}_{i}") for c in cols
                                                   for i, f in enumerate((F.count, F.min, F.max, F.avg))]).first()
    varied = {c for c in cols if facts[f"{c}_0"] and facts[f"{c}_1"] < facts[f"{c}_2"]}
    complete = [c for c in cols if c in varied and facts[f"{c}_0"] == facts["n"]]
    pairs = list(combinations(cols, 2))
    full = [p for p in pairs if p[0] in complete and p[1] in complete]
    gaps = [p for p in pairs if p not in set(full) and p[0] in varied and p[1] in varied]
    flat = [p for p in pairs if p[0] not in varied or p[1] not in varied]
    parts = []
    if len(complete) > MATRIX_COLUMNS:
        parts.append(_matrix_pairs(df, complete))
    elif full:
        parts.append(_pair_table(df, full, F.corr, "correlation"))
    if gaps:
        some = [c for c in cols if any(c in p for p in gaps)]
        made = (_pair_table(df, gaps, correlation, "correlation") if len(gaps) <= PAIRS_PER_PASS
                else _masked_pairs(df, some, [float(facts[f"{c}_3"]) for c in some]))
        known = {frozenset(p) for p in full}
        wanted = F.array(*[F.lit(f"{i} {j}") for i, j in combinations(range(len(some)), 2) if frozenset((some[i], some[j])) not in known])
        parts.append(made if len(gaps) <= PAIRS_PER_PASS else made.filter(F.array_contains(wanted, F.concat_ws(" ", "i", "j"))).drop("i", "j"))
    if flat:
        parts.append(df.sparkSession.createDataFrame([(a, b, None) for a, b in flat], "column_a string, column_b string, correlation double"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _masked_pairs(df: DataFrame, cols: Sequence[str], shifts: Sequence[float]) -> DataFrame:
    """(i, j, column_a, column_b, correlation) over the complete rows of each pair, from one pass over the table.

    Each task sums products of the shifted values and of the masks; the sums of a pair are added up by Spark.
    """
    size, away = len(cols), np.asarray(shifts)
    rows, at = np.triu_indices(size, 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - away
            there = ~np.isnan(x)
            z, m = np.where(there, x, 0.0), there.astype(float)
            total += np.stack([m.T @ m, z.T @ m, m.T @ z, (z * z).T @ m, m.T @ (z * z), z.T @ z])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(at, pa.int32()), *[pa.array(t[rows, at]) for t in total]],
                                         names=["i", "j", "n", "si", "sj", "sii", "sjj", "sij"])
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInArrow(
        sums, "i int, j int, n double, si double, sj double, sii double, sjj double, sij double")
    added = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")])
    n, vi, vj = F.col("n"), F.col("n") * F.col("sii") - F.col("si") ** 2, F.col("n") * F.col("sjj") - F.col("sj") ** 2
    varies = (vi > 1e-12 * n * F.col("sii")) & (vj > 1e-12 * n * F.col("sjj"))
    names = F.array(*[F.lit(c) for c in cols])
    return added.select("i", "j", names[F.col("i")].alias("column_a"), names[F.col("j")].alias("column_b"),
                        F.when(varies, (n * F.col("sij") - F.col("si") * F.col("sj")) / F.sqrt(vi * vj)).alias("correlation"))


def _matrix_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairs of complete columns from one matrix of cross products."""
    vectors = with_vector(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), list(cols), "_v")
    matrix = Correlation.corr(vectors.select("_v"), "_v").first()[0].toArray()
    rows = [(cols[i], cols[j], float(matrix[i, j])) for i, j in combinations(range(len(cols)), 2)]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, correlation double")


def nullity_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation of the missing-value indicators."""
    flags = df.select(*[missing(c).cast("double").alias(c) for c in cols])
    return pearson(flags, cols)


def average_ranks(df: DataFrame, col: str, out: str, rows_per_task: int | None = None) -> DataFrame:
    """Add the 1-based rank of a value, ties sharing their mean rank.

    Ranks are computed on the distinct values with their counts and joined back, so no task sorts the whole column.
    """
    return lookup(df, _rank_table(df, col, out, rows_per_task), [col])


def _rank_table(df: DataFrame, col: str, out: str, rows_per_task: int | None) -> DataFrame:
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    ranks = cumulative_share(counts, col, "_n", rows_per_task)
    return materialise(ranks.select(col, (F.col("_before") + (F.col("_n") + 1) / 2.0).alias(out)), "ranks")


def spearman(df: DataFrame, cols: Sequence[str], rows_per_task: int | None = None) -> DataFrame:
    """Pearson correlation of average ranks.

    The ranks of each column come from the table as it is and are written, so a column costs the same however many there are.
    """
    base = df.select(*cols).na.drop()
    ranked = base
    for c in cols:
        ranked = lookup(ranked, _rank_table(base, c, f"_rank_{c}", rows_per_task), [c])
    return _pair_table(ranked, list(combinations(cols, 2)),
                       lambda a, b: correlation(f"_rank_{a}", f"_rank_{b}"), "correlation")


def correlation_lookup(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> dict[tuple[str, str], float]:
    """The matrix on the driver: one number per ordered pair of columns."""
    if len(cols) < 2:
        return {}
    table = spearman(df, cols) if method == "spearman" else pearson(df, cols)
    out = {}
    for r in table.collect():
        out[(r["column_a"], r["column_b"])] = out[(r["column_b"], r["column_a"])] = r["correlation"]
    return out


def cramers_v(df: DataFrame, a: str, b: str, limit: int | None = None) -> DataFrame:
    """Association of two categorical columns, plain and bias-corrected; NULL where a column has more than `limit` values.

    Rows are reduced to the contingency table first; its margins are sums over that small table.
    """
    cells = df.select(a, b).na.drop().groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n_a"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("n_b"))
    scored = cells.join(rows, a).join(cols, b)
    total = scored.agg(
        F.sum("n").cast("double").alias("n"), F.count_distinct(a).alias("r"), F.count_distinct(b).alias("k"),
        F.sum(F.col("n") * F.col("n") / (F.col("n_a") * F.col("n_b"))).alias("s"))
    n, r, k = F.col("n"), F.col("r"), F.col("k")
    phi2 = F.col("s") - 1
    phi2_fixed = F.greatest(F.lit(0.0), phi2 - F.try_divide((k - 1) * (r - 1), n - 1))
    r_fixed, k_fixed = (c - F.try_divide((c - 1) * (c - 1), n - 1) for c in (r, k))
    known = F.lit(True) if limit is None else (r <= limit) & (k <= limit)
    return total.select(
        F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.when(known, phi2 * n).alias("chi_squared"),
        F.when(known, F.sqrt(F.try_divide(phi2, F.least(r - 1, k - 1)))).alias("cramers_v"),
        F.when(known, F.sqrt(F.try_divide(phi2_fixed, F.least(r_fixed - 1, k_fixed - 1)))).alias("cramers_v_corrected"))


def histogram(df: DataFrame, col: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins between minimum and maximum, empty bins included; the maximum is in the last."""
    ends = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin bigint, lower double, upper double, n bigint")
    width = (hi - lo) or 1.0
    at = F.least(F.floor((F.col(col) - lo) / F.lit(width) * bins), F.lit(bins - 1).cast("long"))
    counts = df.filter(F.col(col).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width / bins)).alias("lower"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width / bins)).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def top_values(df: DataFrame, col: str, rows: int = FREQUENCY_ROWS) -> DataFrame:
    """Most frequent values; equal counts in value order."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "value").limit(rows))


def extreme_values(df: DataFrame, col: str, rows: int = EXTREME_ROWS) -> DataFrame:
    """Lowest and highest distinct values with their counts."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    low = counts.orderBy("value").limit(rows).select(F.lit("lowest").alias("side"), "value", "n")
    high = counts.orderBy(F.desc("value")).limit(rows).select(F.lit("highest").alias("side"), "value", "n")
    return low.unionByName(high)


def text_lengths(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _per_column(df, list(cols), {
        "min_length": lambda c: F.min(F.length(c)).cast("long"), "mean_length": lambda c: F.avg(F.length(c)),
        "max_length": lambda c: F.max(F.length(c)).cast("long")})


def word_counts(df: DataFrame, col: str) -> DataFrame:
    """Occurrences of each blank-separated lower-case word."""
    words = df.select(F.explode(F.split(F.lower(F.col(col)), r"\s+")).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def character_counts(df: DataFrame, col: str) -> DataFrame:
    chars = df.select(F.explode(F.split(F.col(col), "")).alias("character"))
    return chars.filter(F.col("character") != "").groupBy("character").agg(F.count(F.lit(1)).alias("n"))


def duplicate_rows(df: DataFrame, rows: int = DUPLICATE_ROWS) -> DataFrame:
    """Most repeated rows.

    Hashes are counted first; rows are compared whole only for the hashes that are repeated as often as the last one wanted.
    Two rows of one hash can only make a count too high: if that leaves too few rows, all repeated hashes are looked at.
    """
    groups = materialise(_hash_groups(df), "repeated")
    top = groups.orderBy(F.desc("_n")).limit(rows).agg(F.min("_n").alias("least"), F.count(F.lit(1)).alias("n")).first()
    least = top["least"] or 2

    def counted(some: DataFrame, least: int) -> DataFrame:
        return _rows_of(df, some).filter(F.col("_n") >= least).withColumnRenamed("_n", "n_copies").orderBy(F.desc("n_copies"), *df.columns).limit(rows)
    found = counted(groups.filter(F.col("_n") >= least), least)
    return found if top["n"] < rows or found.count() >= rows else counted(groups, 2)


def head_and_tail(df: DataFrame, order: Sequence[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """First and last rows in an explicit order."""
    head = df.orderBy(*order).limit(rows).withColumn("part", F.lit("head"))
    tail = df.orderBy(*[F.desc(c) for c in order]).limit(rows).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def uniformity(df: DataFrame, col: str) -> DataFrame:
    """Chi-squared statistic of the value counts against equal counts."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).cast("double").alias("n"))
    got = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("n")).alias("s"))
    return got.select(F.lit(col).alias("column_name"), F.col("k").alias("n_distinct"),
                      (F.col("s") * F.col("k") / F.col("n") - F.col("n")).alias("chi_squared"))


def uniform_columns(df: DataFrame, cols: Sequence[str], threshold: float = CHI_SQUARED_THRESHOLD) -> DataFrame:
    """Chi-squared statistic and p-value of each column, and whether its values are as good as equally frequent.

    All columns share one aggregate over (column, value); one row a column reaches the driver.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.inline(cells)).filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).cast("double").alias("n"))
    n, s = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    found = {r["column_name"]: (r["k"], r["x"]) for r in counts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("k"), (s * F.count(F.lit(1)) / n - n).alias("x")).collect()}
    rows = []
    for c in cols:
        k, x = found.get(c, (0, None))
        p = chi_squared_tail(x, k - 1) if k > 1 else None
        rows.append((c, k, x, p, p is not None and p > threshold))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, n_distinct bigint, chi_squared double, p_value double, is_uniform boolean")


def alerts(df: DataFrame, correlation_threshold: float = CORRELATION_THRESHOLD,
           skewness_threshold: float = SKEWNESS_THRESHOLD) -> DataFrame:
    """Alert rows (variable, kind, text): constant, zeros, correlated, skewed and uniform columns."""
    cols = numeric_columns(df)
    flags = column_flags(df, df.columns)
    name = F.col("column_name")
    constant = flags.filter("is_constant").select(
        name.alias("variable"), F.lit("constant").alias("kind"),
        F.concat(F.lit("["), name, F.lit("] has constant value")).alias("alert"))
    zeros = flags.filter(F.col("p_zeros") > 0).select(
        name.alias("variable"), F.lit("zeros").alias("kind"),
        F.concat(F.lit("["), name, F.lit("] has "), F.format_string("%.1f%%", F.col("p_zeros") * 100),
                 F.lit(" zeros")).alias("alert"))
    out = constant.unionByName(zeros)
    if len(cols) > 1:
        close = pearson(df, cols).filter(F.abs("correlation") > correlation_threshold)
        both = close.select("column_a", "column_b").unionByName(
            close.select(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b")))
        related = both.select("column_a").distinct().select(
            F.col("column_a").alias("variable"), F.lit("correlated").alias("kind"),
            F.concat(F.lit("["), F.col("column_a"), F.lit("] is highly correlated with other fields")).alias("alert"))
        out = out.unionByName(related)
    if cols:
        skewed = _per_column(df, cols, {"skewness": F.skewness}).filter(F.abs("skewness") > skewness_threshold)
        out = out.unionByName(skewed.select(
            name.alias("variable"), F.lit("skewed").alias("kind"),
            F.concat(F.lit("["), name, F.lit("] is highly skewed")).alias("alert")))
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if texts:
        uniform = uniform_columns(df, texts).filter("is_uniform")
        out = out.unionByName(uniform.select(
            name.alias("variable"), F.lit("uniform").alias("kind"),
            F.concat(F.lit("["), name, F.lit("] is uniformly distributed")).alias("alert")))
    return out
