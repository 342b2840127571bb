"""Queries on payloads, batch inference, the registry and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesml.config import Config
from seriesml.functions.columns import rounded
from seriesml.operators import learners, scale
from seriesml.operators.learners import REGRESSION
from seriesml.plans.lifecycle import Fitted
from seriesml.operators.ordering import dense_index
from seriesml.plans.queries_series import _W, _exploded, _steps_sql, users
from seriesml.plans.registry import ORACLES, ev, long, query, table
from seriesml.sources.payloads import decode_requests, encode_responses
from seriesml.sources.registry import SCHEMA, overview
from seriesml.sources.sinks import FeatureCatalogue
from seriesml.session import scratch_path
from seriesml.streaming import runs, stateful, tables


@query("json_payload_ingest", """WITH {ev} SELECT CAST(user_id AS VARCHAR) AS modeluid, CAST(event_id AS VARCHAR) AS date,
round(value, 6) AS value, round(CAST(k AS DOUBLE), 6) AS k FROM ev""")
def json_payload_ingest(spark, sf):
    """Requests of at most 10,000 rows are built from the events and decoded again."""
    df = ev(spark, sf)
    rows = df.groupBy("user_id", F.floor(F.col("event_id") / 10000)).agg(F.sort_array(F.collect_list(
        F.array(F.col("event_id").cast("double"), "value", F.col("k").cast("double")))).alias("data"))
    payloads = rows.select(F.to_json(F.struct(
        F.struct(F.col("user_id").cast("string").alias("modeluid")).alias("param"),
        F.struct(F.array(F.lit("date"), F.lit("value"), F.lit("k")).alias("headers"), "data").alias("scalar"))).alias("payload"))
    got = decode_requests(payloads, "payload", ["value", "k"])
    return got.select("modeluid", F.col("date").cast("double").cast("long").cast("string").alias("date"),
                      rounded("value").alias("value"), rounded("k").alias("k"))


@query("json_payload_egress", f"""SELECT user_id, CAST(row_number() OVER ({_W}) - 1 AS BIGINT) AS i, round(value, 6) AS y_pred FROM events""")
def json_payload_egress(spark, sf):
    """Answers as JSON, read back row by row."""
    df = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    answers = encode_responses(dense_index(df, users(df), "i"), "user_id", "i", "value", "value")
    parsed = answers.select("user_id", F.explode(F.from_json(
        "response", "scalar struct<data:array<array<double>>>").getField("scalar").getField("data")).alias("d"))
    return parsed.select("user_id", long(F.col("d")[0]).alias("i"), rounded(F.col("d")[1]).alias("y_pred"))


class LinearScore:
    """Fixed linear score of a flat sample."""

    def __init__(self, weights):
        self.weights = weights

    def predict(self, samples, out):
        return samples.select("*", dot_array("x", self.weights).alias(out))


def dot_array(col, weights):
    return F.aggregate(F.zip_with(F.col(col), F.lit([float(w) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


@query("infer_batch", f"""WITH {{ev}},
a AS (SELECT *, CASE WHEN count(value) OVER w = 10 THEN avg(value) OVER w END AS value_mean FROM ev
      WINDOW w AS ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
b AS (SELECT * FROM a WHERE value_mean IS NOT NULL),
c AS (SELECT user_id, row_number() OVER ({_W}) - 1 AS i, value / 500 AS x1, value_mean / 500 AS x2 FROM b)
SELECT user_id, CAST(i // 5 AS BIGINT) AS sample, 'linear' AS method,
       round(10 + 200 * sum((i % 5 + 1) * x1 - 0.5 * (i % 5 + 1) * x2), 6) + 0.0 AS y_pred
FROM c GROUP BY user_id, i // 5 HAVING count(*) = 5""")
def infer_batch(spark, sf):
    config = Config.from_mapping({"clean": {"target": "target"}, "featurize": {"add_mean": ["value"]},
                                  "sequentialize": {"window_size": 5}})
    weights = [w for t in range(1, 6) for w in (float(t), -0.5 * t)]
    fitted = Fitted(config, ("user_id",), ("ts", "event_id"), FeatureCatalogue(("target",), ("value", "value_mean")), ("value",), None,
                    scale.Scaler("minmax", {"value": 0.0, "value_mean": 0.0}, {"value": 500.0, "value_mean": 500.0}),
                    scale.Scaler("standard", {"target": 10.0}, {"target": 200.0}), {"linear": LinearScore(weights)})
    df = table(spark, sf, "events").select("user_id", "ts", "event_id", "value", (F.col("value") * 0).alias("target"))
    got = fitted.transform(df)
    return got.select("user_id", long("sample").alias("sample"), "method", rounded("y_pred").alias("y_pred"))


@query("registry_overview", """WITH {ev}, m AS (SELECT event_type, avg(value) AS a, max(value) AS b, avg(k) AS c FROM ev GROUP BY 1)
SELECT event_type AS model_id, 'events' AS dataset, 'value' AS target, 'dt' AS method, CAST(10 AS INTEGER) AS window_size,
       CASE WHEN a >= c THEN 'value' ELSE 'k' END AS top_feature, metric, round(score, 6) AS score FROM (
  SELECT *, 'mean' AS metric, a AS score FROM m UNION ALL SELECT *, 'top', b FROM m)""")
def registry_overview(spark, sf):
    stats = ev(spark, sf).groupBy("event_type").agg(F.avg("value").alias("a"), F.max("value").alias("b"), F.avg("k").alias("c"))
    params = F.to_json(F.struct(
        F.struct(F.lit("events").alias("dataset")).alias("profile"),
        F.struct(F.lit("value").alias("target"), F.lit(False).alias("classification")).alias("clean"),
        F.struct(F.lit("dt").alias("learning_method")).alias("train"),
        F.struct(F.lit(10).alias("window_size")).alias("sequentialize")))
    rows = stats.select(
        F.col("event_type").alias("model_id"), params.alias("params"),
        F.create_map(F.lit("mean"), F.col("a"), F.lit("top"), F.col("b")).alias("metrics"),
        F.array(F.struct(F.lit("value").alias("feature"), F.col("a").alias("importance")),
                F.struct(F.lit("k").alias("feature"), F.col("c").alias("importance"))).alias("importances"))
    assert [f.split()[0] for f in SCHEMA.split(", ")] == rows.columns
    return overview(rows).withColumn("score", rounded("score"))


# ---------------------------------------------------------------- streams over the events file

def _events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = runs.read_files(spark, sf, schema, "events.parquet")
    return stream.withColumns({"k": F.get_json_object("props", "$.k").cast("int"), "at": F.unix_micros(F.col("ts").cast("timestamp"))})


@query("stream_score", """WITH {ev}, m AS (SELECT regr_slope(value, k) AS a, regr_intercept(value, k) AS b FROM ev)
SELECT event_id, round(b + a * k, 6) AS y_pred FROM ev, m""")
def stream_score(spark, sf):
    batch = learners.with_vector(ev(spark, sf).withColumn("label", F.col("value")), ["k"])
    model = learners.fit(batch, "linearregression", REGRESSION)
    scored = runs.score_stream(_events_stream(spark, sf).select("event_id", "k"), model, ["k"])
    return runs.run_available(scored, "scores").select("event_id", rounded("y_pred").alias("y_pred"))


@query("stream_rolling", ORACLES["roll_mean"])
def stream_rolling(spark, sf):
    rolled = stateful.rolling_stream(_events_stream(spark, sf), "user_id", "event_id", "value", "mean", 10)
    return runs.run_available(rolled, "rolling").filter(~F.col("late")).select("event_id", rounded("value_mean").alias("value_mean"))


@query("stream_sequences", _steps_sql(8, 4))
def stream_sequences(spark, sf):
    samples = stateful.sample_stream(_events_stream(spark, sf), "user_id", ["at", "event_id"], ["value", "k"], 8, 4)
    return _exploded(runs.run_available(samples, "samples").filter(~F.col("late")), ["value", "k"])


@query("stream_late_rows", """SELECT user_id, count(*) - count(DISTINCT CAST(ts AS DATE)) AS n_late FROM events GROUP BY user_id
HAVING count(*) > count(DISTINCT CAST(ts AS DATE))""")
def stream_late_rows(spark, sf):
    """With the day as the only order, every row of a user but the first of a day is late, and comes out as such."""
    days = _events_stream(spark, sf).withColumn("day", F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")))
    samples = runs.run_available(stateful.sample_stream(days, "user_id", "day", ["value"], 8, 4), "late")
    return samples.filter("late").groupBy("user_id").agg(F.count("*").alias("n_late"))


@query("stream_rolling_table", ORACLES["roll_mean"])
def stream_rolling_table(spark, sf):
    """Rolling means with the state kept as a table."""
    got = tables.rolling_table(_events_stream(spark, sf), scratch_path(spark, "rolling"), "user_id", "event_id", "value", "mean", 10)
    return got.filter(~F.col("late")).select("event_id", rounded("value_mean").alias("value_mean"))


@query("stream_sample_table", _steps_sql(8, 4))
def stream_sample_table(spark, sf):
    """Windowed samples with the state kept as a table; a series may be silent for ten years."""
    samples = tables.sample_table(_events_stream(spark, sf), scratch_path(spark, "samples"), "user_id", ["at", "event_id"], ["value", "k"], 8, 4,
                                  tables.Expiry("ts", 10 * 366 * 86400.0))
    return _exploded(samples.filter(~F.col("late")), ["value", "k"])


@query("stream_score_table", ORACLES["stream_score"])
def stream_score_table(spark, sf):
    """Predictions into a table in which a repeated batch replaces itself."""
    batch = learners.with_vector(ev(spark, sf).withColumn("label", F.col("value")), ["k"])
    scored = runs.score_stream(_events_stream(spark, sf).select("event_id", "k"), learners.fit(batch, "linearregression", REGRESSION), ["k"])
    return tables.replacing_table(scored, scratch_path(spark, "scores")).select("event_id", rounded("y_pred").alias("y_pred"))
