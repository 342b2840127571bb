"""Queries on ordered series: features, splits, scaling, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesml.functions.columns import rounded
from seriesml.operators import clean, encode, features, peaks, scale, sequence, split
from seriesml.operators.evaluate import regression_metrics
from seriesml.operators.ordering import series_layout
from seriesml.plans.registry import ev, long, query, table

ORDER = ["ts", "event_id"]


def users(df):
    return series_layout(df, ["user_id"], ORDER)


def one_series(df):
    return series_layout(df, [], ORDER)


# ---------------------------------------------------------------- flagship

@query("flagship_rolling_forecast", """
WITH {ev},
a AS (SELECT * FROM ev WHERE value_n IS NOT NULL),
b AS (SELECT *, CASE WHEN count(value) OVER w = 10 THEN avg(value) OVER w END AS value_mean FROM a
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
c AS (SELECT * FROM b WHERE value_mean IS NOT NULL),
d AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1
                      < floor(count(*) OVER (PARTITION BY user_id) * CAST(0.7 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
      FROM c),
p AS (SELECT min(value) AS lo, max(value) AS hi FROM d WHERE split = 'train'),
e AS (SELECT split, (value - lo) / (hi - lo) AS y, (value_mean - lo) / (hi - lo) AS yp FROM d, p),
m AS (SELECT split, avg(y) AS my FROM e GROUP BY split)
SELECT e.split, count(*) AS n, round(sqrt(avg((y - yp) * (y - yp))), 6) AS rmse,
       round(1 - sum((y - yp) * (y - yp)) / sum((y - my) * (y - my)), 6) AS r2
FROM e JOIN m ON e.split = m.split GROUP BY e.split""")
def flagship(spark, sf):
    df = clean.drop_missing(ev(spark, sf).select("user_id", "ts", "event_id", "value", "value_n"), ["value_n"])
    layout = users(df)
    rolled = features.engineer(df, layout, {"mean": ["value"]}, {"mean": 10}).filter(F.col("value_mean").isNotNull())
    parted = split.split_rows(rolled, layout, 0.7)
    fitted = scale.fit_scaler(parted.filter("split = 'train'"), ["value"], "minmax")
    lo, width = fitted.centers["value"], fitted.scales["value"]
    scored = parted.select("split", ((F.col("value") - lo) / width).alias("y"),
                           ((F.col("value_mean") - lo) / width).alias("y_pred"))
    got = regression_metrics(scored, "y", "y_pred", ["split"])
    return got.select("split", "n", rounded("rmse").alias("rmse"), rounded("r2").alias("r2"))


# ---------------------------------------------------------------- rolling and shape features

_W = "PARTITION BY user_id ORDER BY ts, event_id"
_ROLL = {"roll_sum": ("sum", "sum(value)"), "roll_mean": ("mean", "avg(value)"), "roll_max": ("maximum", "max(value)"),
         "roll_min": ("minimum", "min(value)"), "roll_range": ("min_max_range", "max(value) OVER w - min(value)"),
         "roll_std": ("standard_deviation", "stddev_samp(value)")}


def _feature_query(name, feature, sql_expr):
    @query(name, f"""
WITH {{ev}}
SELECT event_id, round({sql_expr}, 6) + 0.0 AS value_{feature} FROM ev
WINDOW s AS ({_W}), w AS ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
    def run(spark, sf):
        df = ev(spark, sf).select("user_id", "ts", "event_id", "value")
        got = features.engineer(df, users(df), {feature: ["value"]})
        return got.select("event_id", rounded(f"value_{feature}").alias(f"value_{feature}"))
    return run


for _name, (_feature, _expr) in _ROLL.items():
    _feature_query(_name, _feature, f"CASE WHEN count(value) OVER w = 10 THEN {_expr} OVER w END")

_GRADIENT = """CASE WHEN lag(value) OVER s IS NOT NULL AND lead(value) OVER s IS NOT NULL
    THEN (lead(value) OVER s - lag(value) OVER s) / 2.0
    WHEN lead(value) OVER s IS NOT NULL THEN lead(value) OVER s - value ELSE value - lag(value) OVER s END"""
_SLOPE = "atan((value - lag(value, 2) OVER s) / CAST(0.2 AS DOUBLE))"
_feature_query("feat_gradient", "gradient", _GRADIENT)
_feature_query("feat_slope", "slope", _SLOPE)
_feature_query("feat_slope_sin", "slope_sin", f"sin({_SLOPE})")
_feature_query("feat_slope_cos", "slope_cos", f"cos({_SLOPE})")
_feature_query("feat_variance", "variance", "var_pop(value) OVER (PARTITION BY user_id)")


@query("feat_slope_smoothed", f"""
WITH {{ev}}, a AS (SELECT *, abs({_SLOPE}) AS ang FROM ev WINDOW s AS ({_W}))
SELECT event_id, round(CASE WHEN count(ang) OVER w = 5 THEN avg(ang) OVER w END, 6) AS value_slope FROM a
WINDOW w AS ({_W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def feat_slope_smoothed(spark, sf):
    df = ev(spark, sf).select("user_id", "ts", "event_id", "value")
    got = features.smoothed_slope(df, users(df), "value", "value_slope", 5, True)
    return got.select("event_id", rounded("value_slope").alias("value_slope"))


def _all_sql():
    cols = []
    for c in ("value", "k"):
        for feature, expr in _ROLL.values():
            cols.append(f"round(CASE WHEN count({c}) OVER w = 10 THEN {expr.replace('value', c)} OVER w END, 6) + 0.0 AS {c}_{feature}")
        cols.append(f"round({_GRADIENT.replace('value', c)}, 6) + 0.0 AS {c}_gradient")
        slope = _SLOPE.replace("value", c)
        cols += [f"round({slope}, 6) + 0.0 AS {c}_slope", f"round(sin({slope}), 6) + 0.0 AS {c}_slope_sin",
                 f"round(cos({slope}), 6) + 0.0 AS {c}_slope_cos",
                 f"round(var_pop({c}) OVER (PARTITION BY user_id), 6) AS {c}_variance"]
    return f"""WITH {{ev}} SELECT event_id, {', '.join(cols)}
FROM (SELECT * REPLACE (CAST(k AS DOUBLE) AS k) FROM ev)
WINDOW s AS ({_W}), w AS ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""


@query("feat_all", _all_sql())
def feat_all(spark, sf):
    df = ev(spark, sf).select("user_id", "ts", "event_id", "value", F.col("k").cast("double").alias("k"))
    got = features.engineer_all(df, users(df), ["value", "k"], peaks=False)
    made = [c for c in got.columns if c.startswith(("value_", "k_"))]
    return got.select("event_id", *[rounded(c).alias(c) for c in made])


_CANDIDATES = """
r AS (SELECT user_id, i, value, lag(value) OVER (PARTITION BY user_id ORDER BY i) AS pv FROM
       (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM {source})),
u AS (SELECT user_id, i AS lo, value, lead(i) OVER x AS nxt, lag(value) OVER x AS before, lead(value) OVER x AS after
      FROM r WHERE pv IS NULL OR pv <> value WINDOW x AS (PARTITION BY user_id ORDER BY i)),
c AS (SELECT user_id, (lo + nxt - 1) // 2 AS pos, value AS height FROM u WHERE before < value AND after < value)"""
_GREEDY = """
g AS (SELECT user_id, list({'h': height, 'p': pos} ORDER BY height DESC, pos DESC) AS rem, CAST([] AS BIGINT[]) AS kept
      FROM c GROUP BY user_id
      UNION ALL
      SELECT user_id, list_filter(rem, lambda x: abs(x.p - rem[1].p) >= 5), list_append(kept, rem[1].p) FROM g WHERE len(rem) > 0),
peaks AS (SELECT user_id, unnest(kept) AS pos FROM g WHERE len(rem) = 0)"""


@query("feat_peak_candidates", "WITH {ev}, " + _CANDIDATES.replace("{source}", "ev") + """
SELECT user_id, CAST(pos AS BIGINT) AS pos, round(height, 6) AS height FROM c""")
def feat_peak_candidates(spark, sf):
    df = ev(spark, sf).select("user_id", "ts", "event_id", "value")
    layout = users(df)
    got = peaks.peak_candidates(peaks.dense_index(df, layout), layout, "value")
    return got.select("user_id", "pos", rounded("height").alias("height"))


@query("feat_peaks", "WITH RECURSIVE {ev}, " + _CANDIDATES.replace("{source}", "ev") + "," + _GREEDY + """
SELECT user_id, CAST(pos AS BIGINT) AS pos FROM peaks""")
def feat_peaks(spark, sf):
    df = ev(spark, sf).select("user_id", "ts", "event_id", "value")
    return peaks.peak_positions(df, users(df), "value").select("user_id", "pos")


_PEAK_FREQ = """,
o AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM {source}),
f AS (SELECT user_id, pos, CAST(10 AS DOUBLE) / (pos - coalesce(lag(pos) OVER (PARTITION BY user_id ORDER BY pos), -1) - 1) AS fq
      FROM {peaks}),
h AS (SELECT o.user_id, o.event_id, o.i,
             coalesce(last_value(f.fq IGNORE NULLS) OVER (PARTITION BY o.user_id ORDER BY o.i
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS fq
      FROM o LEFT JOIN f ON o.user_id = f.user_id AND o.i = f.pos)
SELECT event_id, round(CASE WHEN count(fq) OVER w = 200 THEN avg(fq) OVER w END, 6) AS value_peak_frequency FROM h
WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)"""
_ONE = "(SELECT 0 AS user_id, ts, event_id, value FROM events)"


def _peak_frequency(spark, sf, distance):
    df = table(spark, sf, "events").select("ts", "event_id", "value")
    got = peaks.peak_frequency(df, one_series(df), "value", "value_peak_frequency", 200, distance)
    return got.select("event_id", rounded("value_peak_frequency").alias("value_peak_frequency"))


@query("feat_peak_freq_d1", "WITH " + _CANDIDATES.replace("{source}", _ONE).strip()
       + _PEAK_FREQ.replace("{source}", _ONE).replace("{peaks}", "c"))
def feat_peak_freq_d1(spark, sf):
    return _peak_frequency(spark, sf, 1)


@query("feat_peak_frequency", "WITH RECURSIVE " + _CANDIDATES.replace("{source}", _ONE).strip() + "," + _GREEDY
       + _PEAK_FREQ.replace("{source}", _ONE).replace("{peaks}", "peaks"))
def feat_peak_frequency(spark, sf):
    return _peak_frequency(spark, sf, 5)


# ---------------------------------------------------------------- split

_TAG = "CASE WHEN {i} < floor({n} * CAST(0.7 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split"


@query("split_rows", "SELECT event_id, " + _TAG.format(i="row_number() OVER (ORDER BY ts, event_id) - 1", n="count(*) OVER ()")
       + " FROM events")
def split_rows(spark, sf):
    df = table(spark, sf, "events").select("ts", "event_id")
    return split.split_rows(df, one_series(df), 0.7).select("event_id", "split")


@query("split_rows_by_series", "SELECT event_id, user_id, " + _TAG.format(
    i=f"row_number() OVER ({_W}) - 1", n="count(*) OVER (PARTITION BY user_id)") + " FROM events")
def split_rows_by_series(spark, sf):
    df = table(spark, sf, "events").select("user_id", "ts", "event_id")
    return split.split_rows(df, users(df), 0.7).select("event_id", "user_id", "split")


@query("split_files", "WITH u AS (SELECT user_id, " + _TAG.format(
    i="row_number() OVER (ORDER BY user_id) - 1", n="count(*) OVER ()")
    + " FROM (SELECT DISTINCT user_id FROM events)) SELECT event_id, e.user_id, split FROM events e JOIN u ON e.user_id = u.user_id")
def split_files(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_id")
    return split.split_series(df, "user_id", 0.7).select("event_id", "user_id", "split")


# ---------------------------------------------------------------- scaling (fit on the first 70 % of each series)

_SPLIT_EV = "WITH {ev}, s AS (SELECT *, " + _TAG.format(
    i=f"row_number() OVER ({_W}) - 1", n="count(*) OVER (PARTITION BY user_id)") + " FROM ev)"


def _split_ev(spark, sf):
    df = ev(spark, sf).select("user_id", "ts", "event_id", "value", "k")
    return split.split_rows(df, users(df), 0.7)


@query("scale_standard", _SPLIT_EV + """,
p AS (SELECT avg(value) AS m, stddev_pop(value) AS s, avg(k) AS mk, stddev_pop(k) AS sk FROM s WHERE split = 'train')
SELECT event_id, round((value - m) / p.s, 6) + 0.0 AS value, round((k - mk) / sk, 6) + 0.0 AS k FROM s, p""")
def scale_standard(spark, sf):
    df = _split_ev(spark, sf)
    got = scale.apply_scaler(df, scale.fit_scaler(df.filter("split = 'train'"), ["value", "k"], "standard"))
    return got.select("event_id", rounded("value").alias("value"), rounded("k").alias("k"))


@query("scale_robust", _SPLIT_EV + """,
p AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS s FROM s WHERE split = 'train')
SELECT event_id, round((value - m) / CASE WHEN p.s = 0 THEN 1 ELSE p.s END, 6) + 0.0 AS value FROM s, p""")
def scale_robust(spark, sf):
    df = _split_ev(spark, sf)
    got = scale.apply_scaler(df, scale.fit_scaler(df.filter("split = 'train'"), ["value"], "robust"))
    return got.select("event_id", rounded("value").alias("value"))


_MM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("scale_minmax", "WITH p AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _MM)
       + " FROM lineitem) SELECT l_orderkey, "
       + ", ".join(f"round(({c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE hi_{c} - lo_{c} END, 6) AS {c}" for c in _MM)
       + ", CAST(0.0 AS DOUBLE) AS const FROM lineitem, p")
def scale_minmax(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", *_MM, F.lit(1.0).alias("const"))
    got = scale.apply_scaler(df, scale.fit_scaler(df, [*_MM, "const"], "minmax"))
    return got.select("l_orderkey", *[rounded(c).alias(c) for c in (*_MM, "const")])


@query("scale_target", """WITH p AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / s, 6) + 0.0 AS o_totalprice FROM orders, p""")
def scale_target(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    fitted = scale.fit_target_scaler(df, ["o_totalprice"], "standard", classification=False)
    return scale.apply_scaler(df, fitted).select("o_orderkey", rounded("o_totalprice").alias("o_totalprice"))


@query("scale_inverse", "SELECT event_id, round(value, 6) AS value, round(CAST(json_extract_string(props, '$.k') AS DOUBLE), 6) AS k FROM events")
def scale_inverse(spark, sf):
    df = ev(spark, sf).select("event_id", "value", F.col("k").cast("double").alias("k"))
    fitted = scale.fit_scaler(df, ["value", "k"], "robust")
    got = scale.invert_scaler(scale.apply_scaler(df, fitted), fitted)
    return got.select("event_id", rounded("value").alias("value"), rounded("k").alias("k"))


# ---------------------------------------------------------------- samples

_IDX = "WITH {ev}, o AS (SELECT *, row_number() OVER (" + _W + ") - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM ev)"


def _samples_sql(window, stride, ahead=0):
    """Sample numbers with a complete window, and the index where each starts."""
    return _IDX + f""", q AS (SELECT user_id, CAST(unnest(range(0, (n - {window + ahead}) // {stride} + 1)) AS BIGINT) AS sample
      FROM (SELECT DISTINCT user_id, n FROM o WHERE n >= {window + ahead})),
st AS (SELECT user_id, sample, sample * {stride} AS start FROM q)"""


def _exploded(samples, cols):
    """(user_id, sample, position, values) of two-dimensional samples."""
    steps = samples.select("user_id", long("sample").alias("sample"), F.posexplode("x").alias("pos", "v"))
    return steps.select("user_id", "sample", long("pos").alias("pos"),
                        *[rounded(F.col("v")[i]).alias(c) for i, c in enumerate(cols)])


def _steps_sql(window, stride):
    return _samples_sql(window, stride) + f"""
SELECT st.user_id, sample, CAST(i - start AS BIGINT) AS pos, round(value, 6) AS value, round(CAST(k AS DOUBLE), 6) AS k
FROM st JOIN o ON o.user_id = st.user_id AND i >= start AND i < start + {window}"""


def _ev_series(spark, sf):
    df = ev(spark, sf).select("user_id", "ts", "event_id", "value", "k")
    return df, users(df)


@query("seq_tumbling", _steps_sql(10, 10))
def seq_tumbling(spark, sf):
    df, layout = _ev_series(spark, sf)
    return _exploded(sequence.sequences(df, layout, ["value", "k"], ["value"], 10), ["value", "k"])


@query("seq_overlap", _steps_sql(10, 3))
def seq_overlap(spark, sf):
    df, layout = _ev_series(spark, sf)
    return _exploded(sequence.sequences(df, layout, ["value", "k"], ["value"], 10, overlap=7), ["value", "k"])


@query("seq_inputs_only", _steps_sql(8, 4))
def seq_inputs_only(spark, sf):
    df, layout = _ev_series(spark, sf)
    return _exploded(sequence.input_sequences(df, layout, ["value", "k"], 8, 4), ["value", "k"])


def _targets(samples):
    steps = samples.select("user_id", long("sample").alias("sample"), F.posexplode("y").alias("pos", "y"))
    return steps.select("user_id", "sample", long("pos").alias("pos"), rounded("y").alias("y"))


@query("seq_target_back", _samples_sql(10, 5) + """
SELECT st.user_id, sample, CAST(i - start - 7 AS BIGINT) AS pos, round(value, 6) AS y
FROM st JOIN o ON o.user_id = st.user_id AND i >= start + 7 AND i < start + 10""")
def seq_target_back(spark, sf):
    df, layout = _ev_series(spark, sf)
    return _targets(sequence.sequences(df, layout, ["k"], ["value"], 10, target_size=3, overlap=5))


@query("seq_target_future", _samples_sql(10, 5, 3) + """
SELECT st.user_id, sample, CAST(i - start - 10 AS BIGINT) AS pos, round(value, 6) AS y
FROM st JOIN o ON o.user_id = st.user_id AND i >= start + 10 AND i < start + 13""")
def seq_target_future(spark, sf):
    df, layout = _ev_series(spark, sf)
    return _targets(sequence.sequences(df, layout, ["k"], ["value"], 10, target_size=3, overlap=5, future=True))


@query("seq_multi_target", _samples_sql(10, 10) + """,
t AS (SELECT st.user_id, sample, i - start - 8 AS step, value, k FROM st JOIN o ON o.user_id = st.user_id AND i >= start + 8 AND i < start + 10)
SELECT user_id, sample, CAST(step * 2 AS BIGINT) AS pos, round(value, 6) AS y FROM t
UNION ALL SELECT user_id, sample, CAST(step * 2 + 1 AS BIGINT), round(CAST(k AS DOUBLE), 6) FROM t""")
def seq_multi_target(spark, sf):
    df, layout = _ev_series(spark, sf)
    return _targets(sequence.sequences(df, layout, ["k"], ["value", "k"], 10, target_size=2))


_FLAT = ", ".join(f"round(max(CASE WHEN i - start = {t} THEN value END), 6) AS value_{t}, "
                  f"round(max(CASE WHEN i - start = {t} THEN CAST(k AS DOUBLE) END), 6) AS k_{t}" for t in range(4))


@query("seq_flatten", _samples_sql(4, 4) + f"""
SELECT st.user_id, sample, {_FLAT} FROM st JOIN o ON o.user_id = st.user_id AND i >= start AND i < start + 4
GROUP BY st.user_id, sample""")
def seq_flatten(spark, sf):
    df, layout = _ev_series(spark, sf)
    flat = sequence.flatten_samples(sequence.input_sequences(df, layout, ["value", "k"], 4))
    names = sequence.flat_names(["value", "k"], 4)
    return flat.select("user_id", long("sample").alias("sample"),
                       *[rounded(F.col("x")[i]).alias(c) for i, c in enumerate(names)])


@query("combine_counts", _SPLIT_EV + """, c AS (SELECT user_id, split, count(*) // 10 AS n_samples FROM s GROUP BY user_id, split)
SELECT user_id, split, CAST(n_samples AS BIGINT) AS n_samples FROM c WHERE n_samples > 0""")
def combine_counts(spark, sf):
    df = _split_ev(spark, sf)
    layout = series_layout(df, ["user_id", "split"], ORDER)
    samples = sequence.sequences(df, layout, ["value", "k"], ["value"], 10)
    return sequence.sample_counts(samples, ["user_id"]).select("user_id", "split", "n_samples")


# ---------------------------------------------------------------- cleaning and encoding

@query("scan_union_by_name", """SELECT event_id, user_id, value, NULL AS extra FROM events WHERE event_type = 'error'
UNION ALL BY NAME SELECT event_id, user_id, value, value * 2 AS extra FROM events WHERE event_type = 'purchase'""")
def scan_union_by_name(spark, sf):
    df = table(spark, sf, "events")
    a = df.filter("event_type = 'error'").select("event_id", "user_id", "value")
    b = df.filter("event_type = 'purchase'").select("event_id", "user_id", "value", (F.col("value") * 2).alias("extra"))
    return clean.union_by_name([a, b])


_MONO = ("event_id", "value", "k", "const")


@query("clean_monotonic_flag", "WITH {ev}, l AS (SELECT " + ", ".join(
    f"{c}, lag({c}) OVER (ORDER BY ts, event_id) AS p_{c}" for c in _MONO) + " FROM ev) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, bool_and(p_{c} IS NULL OR {c} >= p_{c}) AS is_monotonic FROM l" for c in _MONO))
def clean_monotonic_flag(spark, sf):
    df = ev(spark, sf)
    return clean.monotonic_columns(df, one_series(df), list(_MONO))


_LI = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("clean_removable", """
WITH d AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(1.0 AS DOUBLE) AS const, 2 * l_quantity AS quantity_dup,
                  CASE WHEN l_linenumber <> 1 THEN 0.0 ELSE l_tax END AS mostly_zero FROM lineitem)
SELECT column_name FROM (
  SELECT 'const' AS column_name, count(DISTINCT const) <= 1 AS r FROM d
  UNION ALL SELECT 'mostly_zero', avg(CASE WHEN mostly_zero = 0 THEN 1.0 ELSE 0.0 END) > 0.5 FROM d
  UNION ALL SELECT 'l_discount', avg(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END) > 0.5 FROM d
  UNION ALL SELECT 'l_tax', avg(CASE WHEN l_tax = 0 THEN 1.0 ELSE 0.0 END) > 0.5 FROM d
  UNION ALL SELECT 'quantity_dup', corr(l_quantity, quantity_dup) > 0.9 FROM d
  UNION ALL SELECT 'l_discount', corr(l_quantity, l_discount) > 0.9 FROM d
  UNION ALL SELECT 'l_tax', corr(l_quantity, l_tax) > 0.9 FROM d) WHERE r""")
def clean_removable(spark, sf):
    df = table(spark, sf, "lineitem").select(
        *_LI, F.lit(1.0).alias("const"), (2 * F.col("l_quantity")).alias("quantity_dup"),
        F.when(F.col("l_linenumber") != 1, F.lit(0.0)).otherwise(F.col("l_tax")).alias("mostly_zero"))
    names = clean.removable_columns(df, "l_extendedprice", 0.5, 0.9)
    return spark.createDataFrame([(n,) for n in names], "column_name string")


@query("clean_drop_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def clean_drop_columns(spark, sf):
    df = table(spark, sf, "lineitem")
    gone = [c for c in df.columns if c not in ("l_orderkey", "l_linenumber", "l_quantity")]
    return clean.drop_columns(df, [*gone, "no_such_column"])


@query("clean_dropna", "WITH {ev} SELECT event_id, k, value_n FROM ev WHERE value_n IS NOT NULL")
def clean_dropna(spark, sf):
    return clean.drop_missing(ev(spark, sf).select("event_id", "k", "value_n"))


@query("feat_select", "WITH {ev} SELECT value, event_id, k FROM ev")
def feat_select(spark, sf):
    return features.select_variables(ev(spark, sf), ["event_id", "k"], ["value"])


@query("feat_numeric_only", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def feat_numeric_only(spark, sf):
    return features.numeric_only(table(spark, sf, "orders"))


@query("feat_bool_to_int", "SELECT event_id, CASE WHEN value > 50 THEN 1 ELSE 0 END AS high FROM events")
def feat_bool_to_int(spark, sf):
    df = table(spark, sf, "events").select("event_id", (F.col("value") > 50).alias("high"))
    return features.booleans_to_int(df)


@query("feat_nan_ratio", f"""
WITH {{ev}}, r AS (SELECT CASE WHEN count(value) OVER w = 10 THEN 1 END AS a, CASE WHEN count(value_n) OVER w = 10 THEN 1 END AS b
  FROM ev WINDOW w AS ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT 'value_mean' AS column_name, round(avg(CASE WHEN a IS NULL THEN 1.0 ELSE 0.0 END), 6) AS p_missing,
       avg(CASE WHEN a IS NULL THEN 1.0 ELSE 0.0 END) > 0.2 AS too_many FROM r
UNION ALL SELECT 'value_n_mean', round(avg(CASE WHEN b IS NULL THEN 1.0 ELSE 0.0 END), 6),
       avg(CASE WHEN b IS NULL THEN 1.0 ELSE 0.0 END) > 0.2 FROM r""")
def feat_nan_ratio(spark, sf):
    df = ev(spark, sf).select("user_id", "ts", "event_id", "value", "value_n")
    got = features.engineer(df, users(df), {"mean": ["value", "value_n"]})
    report = features.missing_report(got, ["value_mean", "value_n_mean"])
    return report.select("column_name", rounded("p_missing").alias("p_missing"), "too_many")


@query("feat_target_corr_filter", """WITH {ev}, c AS (
  SELECT 'k' AS column_name, corr(value, k) AS c FROM ev UNION ALL SELECT 'value_dup', corr(value, value_dup) FROM ev
  UNION ALL SELECT 'value_z', corr(value, value_z) FROM ev)
SELECT column_name FROM c WHERE abs(c) >= 0.5""")
def feat_target_corr_filter(spark, sf):
    df = ev(spark, sf)
    kept = features.target_correlation_filter(df, "value", ["k", "value_dup", "value_z"], 0.5)
    return spark.createDataFrame([(n,) for n in kept], "column_name string")


@query("encode_label", "SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS label FROM events")
def encode_label(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type")
    fitted = encode.fit_labels(df, "event_type")
    return encode.encode_label(df, fitted, "label").select("event_id", "label")


@query("encode_onehot", "WITH d AS (SELECT event_id, dense_rank() OVER (ORDER BY event_type) - 1 AS c FROM events) SELECT event_id, "
       + ", ".join(f"CASE WHEN c = {i} THEN 1 ELSE 0 END AS target_{i}" for i in range(5)) + " FROM d")
def encode_onehot(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type")
    return encode.one_hot(df, encode.fit_labels(df, "event_type"))


@query("decode_argmax", """WITH d AS (SELECT vec_id, embedding AS a FROM embeddings)
SELECT vec_id, CAST(list_position(a, list_max(a)) - 1 AS INTEGER) AS cls, CASE WHEN a[1] > 0.5 THEN 1 ELSE 0 END AS binary_cls FROM d""")
def decode_argmax(spark, sf):
    df = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    return df.select("vec_id", encode.decode("a", 64).alias("cls"), encode.decode(F.col("a")[0], 2).alias("binary_cls"))


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark, sf):
    return clean.distinct_values(table(spark, sf, "orders"), "o_orderpriority")
