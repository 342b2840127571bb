"""Queries of the rules, line dedup, secrets and decontamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesml.llm import decontaminate, line_dedup, quality_rules, secret_scan
from seriesml.llm.registry import query, table


@query("op5_quality_rules", r"""WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, coalesce(source, '') AS host, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN c USING (doc_id)),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base, 10 * n_symbols > n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS lines,
  (word_chars < 2 * n_words OR word_chars > 15 * n_words) AS word_length FROM m),
u AS (UNPIVOT (SELECT host, count(*) AS n_docs, CAST(sum(base::INT) AS DOUBLE) AS base, CAST(sum(symbols::INT) AS DOUBLE) AS symbols,
  CAST(sum(lines::INT) AS DOUBLE) AS lines, CAST(sum(word_length::INT) AS DOUBLE) AS word_length FROM f GROUP BY host) ON base, symbols, lines, word_length INTO NAME rule VALUE n),
p AS (SELECT rule, avg(n / n_docs) AS m, var_pop(n / n_docs) AS v, avg(1.0 / n_docs) AS inv FROM u GROUP BY rule),
q AS (SELECT rule, m, CASE WHEN v - m * (1 - m) * inv > 0 THEN greatest(m * (1 - m) / (v - m * (1 - m) * inv) - 1, 0) ELSE 1e6 END AS k FROM p),
ab AS (SELECT rule, m * k AS a, (1 - m) * k AS b FROM q),
h AS (SELECT host, max((n + a) / (n_docs + a + b)) <= 0.5 AS fine FROM u JOIN ab USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base AS base_failed, NOT base AND fine AS kept FROM f JOIN h USING (host)""")
def op5_quality_rules(spark, sf):
    """Document measures and host verdicts over all documents; the host is the source."""
    rows = quality_rules.judged(table(spark, sf, "documents"), host_col="source")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


LINES_SQL = r"""l AS (SELECT doc_id, i - 1 AS pos, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
e AS (SELECT doc_id, pos, array_to_string(words, ' ') AS said, words FROM l WHERE length(line) >= 32),
d AS (SELECT said, any_value(words) AS words, CAST(len(any_value(words)) AS INT) AS n, min(row(doc_id, pos)) AS f FROM e GROUP BY said),
v AS (SELECT said, n, f, i, array_to_string(list_concat(words[:i-1], words[i+1:]), ' ') AS v FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM d WHERE n >= 8)),
s AS (SELECT v.said FROM v JOIN (SELECT v, i, n, min(f) AS f FROM v GROUP BY v, i, n) g ON v.v = g.v AND v.i = g.i AND v.n = g.n WHERE g.f < v.f),
x AS (SELECT CASE WHEN d.f < v.f THEN v.said ELSE d.said END AS said FROM v JOIN d ON d.said = v.v AND d.n = v.n - 1 AND d.n >= 8),
near AS (SELECT DISTINCT said FROM (SELECT said FROM s UNION ALL SELECT said FROM x)),
gone AS (SELECT e.doc_id, e.pos FROM e JOIN d USING (said) WHERE e.said IN (SELECT said FROM near) OR row(e.doc_id, e.pos) <> d.f),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)"""


@query("op6_line_dedup", f"""WITH {LINES_SQL}
SELECT doc_id, CAST(len(string_split(coalesce(k.text, ''), chr(10))) AS BIGINT) AS n_lines, md5(coalesce(k.text, '')) AS text_md5 FROM documents LEFT JOIN kept k USING (doc_id)""")
def op6_line_dedup(spark, sf):
    """Every document without its repeated lines: what is left, as a digest."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    left = line_dedup.without_lines(docs, line_dedup.repeated_lines(docs))
    text = F.coalesce("text", F.lit(""))
    return left.select("doc_id", F.size(F.split(text, "\n")).cast("long").alias("n_lines"), F.md5(text.cast("binary")).alias("text_md5"))


HITS_SQL = r"""dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ig AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i+k-1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(13, len(w)) AS k FROM iw WHERE len(w) > 0))),
dg AS (SELECT doc_id, i, k, array_to_string(w[i:i+k-1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM dw CROSS JOIN (SELECT DISTINCT k FROM ig) WHERE len(w) >= k)),
hits AS (SELECT DISTINCT doc_id, item_id, i, k FROM dg JOIN ig USING (k, g)),
nh AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id),
ni AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id),
con AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM dw LEFT JOIN nh USING (doc_id) LEFT JOIN ni USING (doc_id))"""


@query("op9_decontamination", f"WITH {HITS_SQL} SELECT * FROM con")
def op9_decontamination(spark, sf):
    """Hit words and items of every document against the whole benchmark."""
    rows = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query("op8_secret_scans")
def op8_secret_scans(spark, sf):
    """Spans of secrets in every document."""
    rows = secret_scan.secret_spans(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "markov")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return rows.select("doc_id", *[count(k).alias(f"n_{k}") for k in secret_scan.KINDS],
                       F.sha2(secret_scan.joined_spans(base).cast("binary"), 256).alias("base_sha256"), secret_scan.joined_spans(F.col("spans")).alias("spans"))
