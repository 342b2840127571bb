"""Document rules and host verdicts: failure rates of hosts, shrunk by an empirical beta prior. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesml.llm.common import joined
from seriesml.session import materialise

BLANKS = r"[\x20\x09-\x0D]+"
#: Rules as SQL over the measures; a document that fails `base` goes, the other rules count for its host only.
RULES = {
    "base": "n_words < 50 OR 100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
#: Documents that the prior weighs as when hosts differ no more than by chance.
ALIKE = 1e6


def _repeat_words() -> tuple[F.Column, F.Column]:
    """The bits for a place, and the words that lie in a window of three words found twice or more in the text.

    Each window is one number: high bits of its hash, then its place in as few bits as the text needs. Sorted, equal
    windows are neighbours; the places of those are then laid over the text. The arrays of one element name a value.
    """
    n = F.size("words")
    bits = F.length(F.bin(n.cast("long")))
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.call_function(
        "shiftleft", F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)), F.col("bits")).bitwiseOR(i.cast("long")))

    def repeated(s):
        def same(x, j):
            mine = F.call_function("shiftright", x, F.col("bits"))
            return (F.coalesce(F.call_function("shiftright", F.get(s, j - 1), F.col("bits")) == mine, F.lit(False))
                    | F.coalesce(F.call_function("shiftright", F.get(s, j + 1), F.col("bits")) == mine, F.lit(False)))
        return F.filter(s, same)
    found = F.transform(F.array(F.sort_array(windows)), repeated)[0]
    places = F.sort_array(F.transform(found, lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1)))
    covered = F.aggregate(
        places, F.expr("named_struct('upto', 0L, 'n', 0L)"),
        lambda acc, p: F.struct((p + 3).alias("upto"), (acc["n"] + p + 3 - F.greatest(acc["upto"], p)).alias("n")), lambda acc: acc["n"])
    return bits, F.when(n >= 3, covered).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every row, without a shuffle.

    A NULL text has no words and no lines; a NULL host is the empty one.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")).alias("host"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    bits, repeat = _repeat_words()
    split = rows.withColumns({"words": F.array_remove(F.split("text", BLANKS), ""), "lines": lines}).withColumn("bits", bits)
    return split.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"))


def host_rates(measured: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """host, n_docs and for each rule the failures and the shrunk rate `<rule>_rate`.

    The beta prior of a rule has the mean of the hosts' own rates and their variance beyond that of chance, m (1 - m) times
    the mean of 1 / n_docs, each host counting once. Where hosts differ no more than by chance, it weighs as ALIKE documents.
    Sums are combined on the map side; a few numbers for each rule reach the driver. No rows give no hosts.
    """
    names = list(rules)
    per = materialise(measured.groupBy("host").agg(F.count("*").alias("n_docs"), *[
        F.sum(F.when(F.expr(rules[r]), 1).otherwise(0)).alias(r) for r in names]), "hosts")
    got = per.agg(*[F.avg(F.col(r) / F.col("n_docs")).alias(f"m_{r}") for r in names],
                  *[F.var_pop(F.col(r) / F.col("n_docs")).alias(f"v_{r}") for r in names], F.avg(1 / F.col("n_docs")).alias("inverse")).first()
    rates = []
    for r in names:
        m = got[f"m_{r}"] or 0.0
        between = (got[f"v_{r}"] or 0.0) - m * (1 - m) * (got["inverse"] or 0.0)
        weight = max(m * (1 - m) / between - 1, 0.0) if between > 0 else ALIKE
        a, b = m * weight, (1 - m) * weight
        rates.append(((F.col(r) + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))).alias(f"{r}_rate"))
    return per.select("host", "n_docs", *names, *rates)


def judged(docs: DataFrame, rules: dict[str, str] = RULES, limits: dict[str, float] | None = None, **columns) -> DataFrame:
    """The measures of every row with base_failed, the host's highest rate over its limit (host_excess), and kept.

    A host is out when the shrunk rate of a rule exceeds its limit (one half, unless `limits` says otherwise); documents of
    such a host go, and those that fail `base` themselves. Repeated rows are judged alike and count once each for the host.
    """
    limits = {r: 0.5 for r in rules} | (limits or {})
    measured = materialise(measures(docs, **columns), "measures")
    rates = host_rates(measured, rules)
    excess = F.greatest(*[F.col(f"{r}_rate") - F.lit(float(limits[r])) for r in rules], F.lit(-1.0))
    hosts = rates.select("host", excess.alias("host_excess"))
    both = joined(measured, hosts, ["host"], "left")
    failed = F.coalesce(F.expr(rules["base"]), F.lit(False))
    return both.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("host_excess") <= 0))
