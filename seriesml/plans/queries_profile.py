"""Profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesml.functions.columns import fixed_decimals, rounded
from seriesml.operators import clean, profile, quantiles
from seriesml.plans.registry import ev, long, query, table
from seriesml.session import materialise

LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _union(parts):
    return " UNION ALL ".join(parts)


@query("profile_overview", f"""
SELECT CAST(11 AS BIGINT) AS n_variables, (SELECT count(*) FROM lineitem) AS n_rows,
       (SELECT CAST({' + '.join(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)' for c in LINE)} AS BIGINT) FROM lineitem) AS n_missing_cells,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(LINE)})) AS n_duplicate_rows""")
def profile_overview(spark, sf):
    return profile.overview(table(spark, sf, "lineitem"))


_KINDS = {"o_orderkey": "numeric", "o_custkey": "numeric", "o_orderstatus": "categorical", "o_totalprice": "numeric",
          "o_orderdate": "datetime", "o_orderpriority": "categorical"}


@query("profile_types", _union(
    f"SELECT '{c}' AS column_name, CASE WHEN '{k}' = 'numeric' AND count(DISTINCT {c}) < 5 THEN 'categorical' ELSE '{k}' END "
    f"AS inferred_type, count(DISTINCT {c}) AS n_distinct FROM orders" for c, k in _KINDS.items()))
def profile_types(spark, sf):
    return profile.column_types(table(spark, sf, "orders"))


@query("profile_numeric", _union(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(var_samp({c}), 2) AS variance, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(max({c}) - min({c}), 6) AS range,
  round(sum({c}), 2) AS sum, round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis,
  round(stddev_samp({c}) / avg({c}), 6) AS cv, round(mad({c}), 6) AS mad FROM lineitem""" for c in MEASURES))
def profile_numeric(spark, sf):
    got = profile.numeric_summary(table(spark, sf, "lineitem"), MEASURES)
    return got.select("column_name", "n", *[rounded(c, 2 if c in ("variance", "sum") else 6).alias(c)
                                            for c in got.columns if c not in ("column_name", "n")])


def _quantile_sql(source, cols):
    qs = ", ".join(f"round(quantile_cont(c, {q / 100}), 6) AS q{q}" for q in (5, 25, 50, 75, 95))
    return _union(f"SELECT '{c}' AS column_name, {qs}, round(quantile_cont(c, 0.75) - quantile_cont(c, 0.25), 6) AS iqr "
                  f"FROM (SELECT CAST({c} AS DOUBLE) AS c FROM {source})" for c in cols)


def _rounded_table(df, keep):
    return df.select(*[c if c in keep else rounded(c).alias(c) for c in df.columns])


@query("profile_quantiles", _quantile_sql("lineitem", MEASURES))
def profile_quantiles(spark, sf):
    return _rounded_table(profile.quantile_summary(table(spark, sf, "lineitem"), MEASURES), ["column_name"])


@query("profile_quantiles_events", "WITH {ev} " + _quantile_sql("ev", ("value", "k", "value_n")))
def profile_quantiles_events(spark, sf):
    return _rounded_table(profile.quantile_summary(ev(spark, sf), ["value", "k", "value_n"]), ["column_name"])


@query("profile_quantiles_narrowed", _quantile_sql("lineitem", MEASURES))
def profile_quantiles_narrowed(spark, sf):
    """The multi-pass way for columns too long for one task, here with small limits."""
    df = table(spark, sf, "lineitem")
    found = profile.exact_quantiles(df, MEASURES, profile.QUANTILES, direct_rows=1000, window_rows=200)
    rows = [(c, *q, q[3] - q[1]) for c, q in found.items()]
    got = spark.createDataFrame(rows, "column_name string, q5 double, q25 double, q50 double, q75 double, q95 double, iqr double")
    return _rounded_table(got, ["column_name"])


@query("profile_quantile_sketches", _union(
    f"SELECT '{c}' AS column_name, CAST({q} AS DOUBLE) AS share, count(*) AS n, true AS within FROM lineitem" for c in MEASURES for q in profile.QUANTILES))
def profile_quantile_sketches(spark, sf):
    """Sketches of every ship month, stored and merged; each quantile's rank, counted exactly, is within half a percent of its share."""
    df = table(spark, sf, "lineitem")
    months = df.withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    stored = materialise(quantiles.quantile_sketches(months, MEASURES, ["month"]), "sketches")
    found = {r["column_name"]: r for r in quantiles.merged_quantiles(stored, profile.QUANTILES).collect()}
    ranks = df.agg(*[F.count(F.when(c, 1)).alias(f"{name}_{i}_{side}") for name, r in found.items() for i, v in enumerate(r["values"])
                     for side, c in (("below", F.col(name) < v), ("upto", F.col(name) <= v))]).first()
    rows = []
    for name, r in found.items():
        for i, q in enumerate(profile.QUANTILES):
            low, high = ranks[f"{name}_{i}_below"] / r["n"], ranks[f"{name}_{i}_upto"] / r["n"]
            rows.append((name, q, r["n"], low - 0.005 <= q <= high + 0.005))
    return spark.createDataFrame(rows, "column_name string, share double, n long, within boolean")


@query("profile_zeros", _union(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} = 0) AS n_zeros, "
    f"round(count(*) FILTER (WHERE {c} = 0) / count(*), 6) AS p_zeros FROM lineitem" for c in ("l_discount", "l_tax")))
def profile_zeros(spark, sf):
    return _rounded_table(profile.zero_counts(table(spark, sf, "lineitem"), ["l_discount", "l_tax"]), ["column_name", "n_zeros"])


@query("profile_distinct", _union(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, round(count(DISTINCT {c}) / count({c}), 6) AS p_distinct, "
    f"count(DISTINCT {c}) <= 1 AS is_constant, count(DISTINCT {c}) = count({c}) AS is_unique FROM orders" for c in ORDERS))
def profile_distinct(spark, sf):
    got = profile.distinct_flags(table(spark, sf, "orders"))
    return got.withColumn("p_distinct", rounded("p_distinct"))


@query("profile_missing", "WITH {ev}, d AS (SELECT value, value_n, CASE WHEN value > 100 THEN NULL ELSE k END AS k_n FROM ev) " + _union(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing, round((count(*) - count({c})) / count(*), 6) AS p_missing FROM d"
    for c in ("value", "value_n", "k_n")))
def profile_missing(spark, sf):
    return _rounded_table(profile.missing_counts(_gaps(spark, sf)), ["column_name", "n_missing"])


def _gaps(spark, sf):
    return ev(spark, sf).select("value", "value_n", F.when(F.col("value") <= 100, F.col("k")).alias("k_n"))


@query("profile_null_corr", """WITH {ev}, d AS (SELECT value, value_n, CASE WHEN value > 100 THEN NULL ELSE k END AS k_n FROM ev),
f AS (SELECT CAST(value_n IS NULL AS INTEGER) AS a, CAST(k_n IS NULL AS INTEGER) AS b FROM d)
SELECT 'value_n' AS column_a, 'k_n' AS column_b, round(corr(a, b), 6) AS correlation FROM f
UNION ALL SELECT 'value', 'value_n', NULL UNION ALL SELECT 'value', 'k_n', NULL""")
def profile_null_corr(spark, sf):
    return _rounded_table(profile.nullity_correlation(_gaps(spark, sf), ["value", "value_n", "k_n"]), ["column_a", "column_b"])


@query("profile_histogram", """WITH m AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
c AS (SELECT CAST(least(floor((value - lo) / (hi - lo) * 50), 49) AS BIGINT) AS bin, count(*) AS n FROM events, m GROUP BY 1),
b AS (SELECT CAST(unnest(range(50)) AS BIGINT) AS bin)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 50), 6) AS lower, round(lo + (b.bin + 1) * ((hi - lo) / 50), 6) AS upper,
       coalesce(n, 0) AS n FROM b CROSS JOIN m LEFT JOIN c ON b.bin = c.bin""")
def profile_histogram(spark, sf):
    return _rounded_table(profile.histogram(table(spark, sf, "events"), "value"), ["bin", "n"])


@query("profile_top_values", "SELECT o_custkey AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def profile_top_values(spark, sf):
    return profile.top_values(table(spark, sf, "orders"), "o_custkey")


@query("profile_extremes", """WITH c AS (SELECT o_totalprice AS value, count(*) AS n FROM orders GROUP BY 1)
SELECT 'lowest' AS side, * FROM (SELECT * FROM c ORDER BY value LIMIT 5)
UNION ALL SELECT 'highest', * FROM (SELECT * FROM c ORDER BY value DESC LIMIT 5)""")
def profile_extremes(spark, sf):
    return profile.extreme_values(table(spark, sf, "orders"), "o_totalprice")


@query("profile_text_length", _union(
    f"SELECT '{c}' AS column_name, min(length({c})) AS min_length, round(avg(length({c})), 6) AS mean_length, max(length({c})) AS max_length "
    f"FROM {t}" for t, c in (("documents", "text"), ("documents", "lang"), ("part", "p_name"), ("part", "p_brand"))))
def profile_text_length(spark, sf):
    got = profile.text_lengths(table(spark, sf, "documents"), ["text", "lang"]).unionByName(
        profile.text_lengths(table(spark, sf, "part"), ["p_name", "p_brand"]))
    return got.withColumn("mean_length", rounded("mean_length"))


@query("profile_words", """SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\x0b\\f\\r]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def profile_words(spark, sf):
    return profile.word_counts(table(spark, sf, "documents"), "text")


@query("profile_characters", """SELECT character, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(p_name, '')) AS character FROM part)
WHERE character <> '' GROUP BY character""")
def profile_characters(spark, sf):
    return profile.character_counts(table(spark, sf, "part"), "p_name")


_BOOL = """CASE o_orderstatus WHEN 'O' THEN 'Yes' WHEN 'F' THEN 'no' END AS yes_no,
CASE WHEN o_orderstatus = 'O' THEN 'T' ELSE 'maybe' END AS other, o_orderstatus"""


@query("profile_bool_infer", f"WITH d AS (SELECT {_BOOL} FROM orders), "
       "v AS (" + _union(f"SELECT '{c}' AS column_name, list(DISTINCT lower({c})) FILTER (WHERE {c} IS NOT NULL) AS s FROM d"
                         for c in ("yes_no", "other", "o_orderstatus")) + """)
SELECT column_name, len(s) > 0 AND (list_has_all(['t', 'f'], s) OR list_has_all(['yes', 'no'], s)
  OR list_has_all(['y', 'n'], s) OR list_has_all(['true', 'false'], s)) AS is_boolean FROM v""")
def profile_bool_infer(spark, sf):
    df = table(spark, sf, "orders").selectExpr(*[p.strip() for p in (
        "CASE o_orderstatus WHEN 'O' THEN 'Yes' WHEN 'F' THEN 'no' END AS yes_no",
        "CASE WHEN o_orderstatus = 'O' THEN 'T' ELSE 'maybe' END AS other", "o_orderstatus")])
    return profile.boolean_columns(df, ["yes_no", "other", "o_orderstatus"])


def _pairs_sql(source, cols, fn):
    return _union(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round({fn(a, b)}, 6) + 0.0 AS correlation FROM {source}"
                  for i, a in enumerate(cols) for b in cols[i + 1:])


_NUM = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("profile_corr", _pairs_sql("lineitem", _NUM, lambda a, b: f"corr({a}, {b})"))
def profile_corr(spark, sf):
    return _rounded_table(profile.pearson(table(spark, sf, "lineitem"), list(_NUM)), ["column_a", "column_b"])


@query("profile_corr_events", "WITH {ev} " + _pairs_sql("ev", ("value", "k", "value_n", "value_dup"), lambda a, b: f"corr({a}, {b})"))
def profile_corr_events(spark, sf):
    return _rounded_table(profile.pearson(ev(spark, sf), ["value", "k", "value_n", "value_dup"]), ["column_a", "column_b"])


@query("profile_spearman", """WITH {ev}, r AS (
  SELECT rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS a,
         rank() OVER (ORDER BY k) + (count(*) OVER (PARTITION BY k) - 1) / 2.0 AS b FROM ev)
SELECT 'value' AS column_a, 'k' AS column_b, round(corr(a, b), 6) + 0.0 AS correlation FROM r""")
def profile_spearman(spark, sf):
    return _rounded_table(profile.spearman(ev(spark, sf), ["value", "k"]), ["column_a", "column_b"])


@query("profile_cramers_v", """WITH n AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY 1, 2),
m AS (SELECT n, sum(n) OVER (PARTITION BY a) AS na, sum(n) OVER (PARTITION BY b) AS nb, a, b FROM n),
t AS (SELECT CAST(sum(n) AS DOUBLE) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k,
             sum(CAST(n AS DOUBLE) * n / (CAST(na AS DOUBLE) * nb)) - 1 AS phi2 FROM m),
f AS (SELECT *, greatest(0, phi2 - (k - 1) * (r - 1) / (n - 1)) AS phi2c, r - (r - 1) * (r - 1) / (n - 1) AS rc,
             k - (k - 1) * (k - 1) / (n - 1) AS kc FROM t)
SELECT 'o_orderstatus' AS column_a, 'o_orderpriority' AS column_b, round(phi2 * n, 6) AS chi_squared,
       round(sqrt(phi2 / least(r - 1, k - 1)), 6) AS cramers_v, round(sqrt(phi2c / least(rc - 1, kc - 1)), 6) AS cramers_v_corrected FROM f""")
def profile_cramers_v(spark, sf):
    return _rounded_table(profile.cramers_v(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"),
                          ["column_a", "column_b"])


@query("profile_duplicates", """SELECT l_returnflag, l_linestatus, l_discount, count(*) AS n_copies FROM lineitem
GROUP BY 1, 2, 3 HAVING count(*) > 1 ORDER BY n_copies DESC, l_returnflag, l_linestatus, l_discount LIMIT 10""")
def profile_duplicates(spark, sf):
    return profile.duplicate_rows(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_discount"))


@query("profile_samples", """SELECT 'head' AS part, * FROM (SELECT event_id, user_id, value FROM events ORDER BY event_id LIMIT 10)
UNION ALL SELECT 'tail', * FROM (SELECT event_id, user_id, value FROM events ORDER BY event_id DESC LIMIT 10)""")
def profile_samples(spark, sf):
    return profile.head_and_tail(table(spark, sf, "events").select("event_id", "user_id", "value"), ["event_id"])


@query("profile_chi2_uniform", """WITH c AS (SELECT event_type, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1),
e AS (SELECT avg(n) AS e, count(*) AS k FROM c)
SELECT 'event_type' AS column_name, any_value(k) AS n_distinct, round(sum((n - e) * (n - e) / e), 6) AS chi_squared FROM c, e""")
def profile_chi2_uniform(spark, sf):
    return _rounded_table(profile.uniformity(table(spark, sf, "events"), "event_type"), ["column_name", "n_distinct"])


_ALERT_TABLE = ", ".join(MEASURES) + ", CAST(1.0 AS DOUBLE) AS const, 2 * l_quantity AS quantity_dup"
_ALERTS = f"""WITH d AS (SELECT {_ALERT_TABLE} FROM lineitem),
z AS ({_union(f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} = 0) / count(*) AS p, count(DISTINCT {c}) AS n FROM d"
              for c in (*MEASURES, 'const', 'quantity_dup'))}),
c AS ({_union(f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN stddev_pop({a}) * stddev_pop({b}) > 0 THEN corr({a}, {b}) END AS c FROM d"
              for i, a in enumerate((*MEASURES, 'const', 'quantity_dup')) for b in (*MEASURES, 'const', 'quantity_dup')[i + 1:])}),
alerts AS (
SELECT variable, 'constant' AS kind, '[' || variable || '] has constant value' AS alert FROM z WHERE n <= 1
UNION ALL SELECT variable, 'zeros', '[' || variable || '] has ' || printf('%.1f', p * 100) || '% zeros' FROM z WHERE p > 0
UNION ALL SELECT DISTINCT v, 'correlated', '[' || v || '] is highly correlated with other fields'
  FROM (SELECT a AS v, c FROM c UNION ALL SELECT b, c FROM c) WHERE abs(c) > 0.9)"""


def _alert_source(spark, sf):
    return table(spark, sf, "lineitem").select(*MEASURES, F.lit(1.0).alias("const"), (2 * F.col("l_quantity")).alias("quantity_dup"))


@query("profile_alerts", _ALERTS + " SELECT variable, kind, alert FROM alerts")
def profile_alerts(spark, sf):
    return profile.alerts(_alert_source(spark, sf))


@query("alert_parse", _ALERTS + """ SELECT alert, regexp_extract(alert, '\\[([^\\]]+)\\]', 1) AS variable,
  list_contains(string_split(alert, ' '), 'constant') AS is_constant, list_contains(string_split(alert, ' '), 'zeros') AS is_zeros,
  list_contains(string_split(alert, ' '), 'correlated') AS is_correlated FROM alerts""")
def alert_parse(spark, sf):
    return clean.parse_alerts(profile.alerts(_alert_source(spark, sf)))


@query("report_rows", """SELECT event_type, count(*) AS n, printf('%.3f', avg(value)) AS mean_value, replace(event_type, 'i', 'I') AS label
FROM events GROUP BY event_type""")
def report_rows(spark, sf):
    got = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"))
    return got.select("event_type", long("n").alias("n"), fixed_decimals("m").alias("mean_value"),
                      F.replace("event_type", F.lit("i"), F.lit("I")).alias("label"))
