"""Queries of language, periodic runs and ranked search."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import functions as F

from seriesml.llm import language, lexical_search, periodic_runs
from seriesml.llm.registry import query, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query("op11_language_id")
def op11_language_id(spark, sf):
    """Language of every document; nothing of the held-out fold is learnt from."""
    docs = table(spark, sf, "documents")
    pieces = language.vocabulary(PIECES)
    model = language.fit_languages(docs, pieces)
    rows = language.languages_of(docs, model, pieces)
    return rows.select("doc_id", F.coalesce(language.fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def periodic(doc_id, words: list[str]) -> list[str]:
    """The contract's rewriting of a tenth of the documents; a document without an id stays as it is."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_TABLE = [0]  # of the remainders of four bits
for _i in range(1, 16):
    _c = _i
    for _ in range(4):
        _c = _c >> 1 ^ (0xEDB88320 if _c & 1 else 0)
    _TABLE.append(_c)
_STEP = f"xor(({{y}}) >> 4, ({_TABLE}::BIGINT[])[(({{y}}) & 15) + 1])"
CRC32 = (f"xor(4294967295::BIGINT, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT), "
         f"lambda r, x: {_STEP.format(y='(' + _STEP.format(y='xor(r, x)') + ')')}, 4294967295::BIGINT))")


@query("op12_periodic_runs", rf"""WITH o AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {CRC32} AS h FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM o),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT doc_id, n, unnest(range(0, n)) AS i, unnest(list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i+1] ELSE w[a+(i-a)%p+1] END)) AS word FROM p),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s u WHERE u.doc_id = s.doc_id AND u.q < s.q AND u.start <= s.start AND u.start + u.length >= s.start + s.length)),
top AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS said,
  min(row(-length, start, q)) AS best FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM r),
left_ AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best[2] AS BIGINT) AS start, CAST(-best[1] AS BIGINT) AS length, CAST(best[3] AS BIGINT) AS period,
  CAST(1000 * -best[1] // best[3] AS BIGINT) AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(left_.text, '')) AS collapsed_sha256
FROM o LEFT JOIN top USING (doc_id) LEFT JOIN left_ USING (doc_id)""")
def op12_periodic_runs(spark, sf):
    """Runs of words of every document, a tenth of them made periodic first."""
    rows = periodic_runs.repeated_runs(table(spark, sf, "documents"), rewrite=periodic)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op13_ranked_search", rf"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
n AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_WORDS}) AS t FROM benchmark) GROUP BY item_id, t),
f AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f CROSS JOIN c GROUP BY t, docs),
m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM n CROSS JOIN c),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10""")
def op13_ranked_search(spark, sf):
    """The ten best documents of every benchmark item."""
    return lexical_search.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
