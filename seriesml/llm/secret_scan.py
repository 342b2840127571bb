"""Secrets in documents: fixed patterns, and tokens more like random strings than like identifiers. DataFrame functions only."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesml.llm.common import documents, row_key
from seriesml.session import materialise

#: kind: pattern, least length, group that the length is of. Matches are leftmost and do not overlap within a kind.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    "access": (r"AKIA[A-Z0-9]+", 20, 0),
    "hex": (r"[0-9a-f]+", 24, 0),
}
#: What a text must hold for a match of enough length; spares the positions of all others.
_HINTS = {"assign": r"""(?i)(?:word|passwd|secret|token|key)["']?\x20*[:=]""", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
TOKEN = r"[A-Za-z0-9+/_=-]+"
_TOKEN_CHARS = 16
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_N = len(ALPHABET) + 1
_PRIOR = 20


def _found(kind: str, pattern: str, group: int, hint: str) -> F.Column:
    """All matches of a kind in order, each with the length of the text before it since the last one."""
    rows = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("said"),
                        F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("part"),
                        F.transform(F.split("text", pattern), F.length).alias("gap"))
    rows = F.when(F.col("text").rlike(hint), rows)
    return F.transform(rows, lambda z, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), z["said"].alias("said"),
                                                   F.length(z["part"]).alias("n"), z["gap"].alias("gap")))


def _least(kind: str) -> int:
    return _TOKEN_CHARS if kind == "markov" else KINDS[kind][1]


def matches(docs: DataFrame) -> DataFrame:
    """key, kind, said, start, end (code points, end exclusive) of the base matches and of the tokens to be judged (markov).

    Java's split gives the text between matches; the running sum of gaps and matches is the place. Texts without a hint of a
    kind give no rows of it. Rows equal in id and text are taken once.
    """
    kinds = {k: (p, g, _HINTS[k]) for k, (p, _, g) in KINDS.items()} | {"markov": (r"[A-Za-z0-9+/_=-]{%d,}" % _TOKEN_CHARS, 0, r"[A-Za-z0-9+/_=-]{%d}" % _TOKEN_CHARS)}
    arrays = [F.coalesce(_found(k, p, g, h), F.expr("CAST(array() AS array<struct<kind:string,i:int,said:string,n:int,gap:int>>)")) for k, (p, g, h) in kinds.items()]
    rows = docs.select(row_key().alias("key"), F.explode(F.concat(*arrays)).alias("m")).select("key", "m.*")
    rows = materialise(rows.filter("said IS NOT NULL"), "matches").distinct()
    upto = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("said")).over(upto).cast("long")
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("said"))
    enough = F.lit(False)
    for k in kinds:
        enough = enough | ((F.col("kind") == k) & (F.col("n") >= _least(k)))
    return placed.filter(enough).select("key", "kind", "said", "start", "end")


def _code(c) -> F.Column:
    return F.instr(F.lit(ALPHABET), c)


def bigram_model(samples: DataFrame) -> list[float]:
    """log P(next | char) of random strings minus that of ordinary ones, a number for each pair of characters.

    `samples` has said and random (boolean). Counts of pairs are combined on the map side, at most two for each pair reach
    the driver. Rare pairs lean on the frequency of the second character alone, as if it had been seen _PRIOR times, and one
    is added to each frequency. Without samples all are 0.
    """
    pairs = samples.filter(F.length("said") > 1).select("random", "said", F.explode(F.sequence(F.lit(1), F.length("said") - 1)).alias("i"))
    coded = pairs.select("random", F.expr(f"instr('{ALPHABET}', substr(said, i, 1)) * {_N} + instr('{ALPHABET}', substr(said, i + 1, 1))").alias("pair"))
    counts = {True: [0] * (_N * _N), False: [0] * (_N * _N)}
    for r in coded.groupBy("random", "pair").count().collect():
        counts[r["random"]][r["pair"]] += r["count"]
    logs = {}
    for kind, c in counts.items():
        nexts = [1 + sum(c[j::_N]) for j in range(_N)]  # of each character as a second one
        total = sum(nexts)
        sums = [sum(c[i * _N:(i + 1) * _N]) for i in range(_N)]
        logs[kind] = [math.log((c[j] + _PRIOR * nexts[j % _N] / total) / (sums[j // _N] + _PRIOR)) for j in range(_N * _N)]
    return [round(a - b, 4) for a, b in zip(logs[True], logs[False])]


def likelihood_ratio(said: str, model: list[float]) -> F.Column:
    """Sum of the model over the pairs of neighbouring characters; above 0 a string is more like the random ones."""
    table = f"from_json('{json.dumps(model)}', 'array<double>')"
    return F.expr(f"""aggregate(sequence(1, greatest(length({said}) - 1, 1)), 0D, (s, i) -> s + coalesce(get({table},
        instr('{ALPHABET}', substr({said}, i, 1)) * {_N} + instr('{ALPHABET}', substr({said}, i + 1, 1))), 0D))""")


def secret_spans(docs: DataFrame, samples: DataFrame | None = None, least_ratio: float = 12.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, doc_id, spans of every row: structs (start, rank, kind, end) by start, then kind as listed, markov last.

    Base spans are all matches of the fixed patterns that are long enough. Tokens of 16 characters or more with a letter
    that touch no base span are added as `markov` where their log-likelihood ratio reaches `least_ratio`. The two Markov
    models are trained from `samples` (said, random); without them from the documents' own: what the patterns match is
    random, tokens outside of matches, all letters and with a vowel in each half, are ordinary. NULL texts have no spans.
    """
    df = documents(docs, id_col, text_col)
    found = materialise(matches(df), "spans")
    line = Window.partitionBy("key")
    base = F.col("kind") != "markov"
    ends = F.max(F.when(base, F.col("end"))).over(line.orderBy("start", F.when(base, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nexts = F.min(F.when(base, F.col("start"))).over(line.orderBy(F.desc("end"), F.when(base, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    tokens = found.withColumns({"upto": ends, "next": nexts}).filter(
        ~base & (F.coalesce("upto", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end")))
    tokens = materialise(tokens.select("key", "kind", "said", "start", "end"), "tokens")
    if samples is None:
        value = F.when(F.col("kind") == "assign", F.regexp_extract("said", KINDS["assign"][0], 2)).otherwise(F.col("said"))
        plain = F.col("said").rlike("^[A-Za-z]+$") & F.col("said").rlike("(?i)^.{0,7}[aeiou].*[aeiou]")
        samples = found.filter(base).select(value.alias("said"), F.lit(True).alias("random")).unionByName(
            tokens.filter(plain).select("said", F.lit(False).alias("random")))
    model = bigram_model(samples)
    judged = tokens.filter(F.col("said").rlike("[A-Za-z]")).filter(likelihood_ratio("said", model) >= least_ratio)
    every = found.filter(base).unionByName(judged)
    rank = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "markov")]), F.col("kind"))
    spans = every.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans"))
    rows = df.select(row_key().alias("key"), "doc_id")
    none = F.expr("CAST(array() AS array<struct<start:bigint,rank:bigint,kind:string,end:bigint>>)")
    return rows.join(spans, "key", "left").withColumn("spans", F.coalesce("spans", none))


def joined_spans(spans: F.Column) -> F.Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
