"""Benchmark passages in documents: winnowed k-grams, joined and extended to whole shared spans. DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesml.llm.common import documents, joined, row_key
from seriesml.session import materialise

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> F.Column:
    """Words with A-Z in lower case; only ASCII letters change, so other capitals stay what they are."""
    plain = F.octet_length(text) == F.length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _grams(words: str, k: int) -> F.Column:
    """Hash of each k consecutive words."""
    def gram(i):
        return F.xxhash64(*[F.get(F.col(words), i + j) for j in range(k)])
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), gram)).otherwise(F.array().cast("array<bigint>"))


def _winnowed(grams: str, width: int) -> F.Column:
    """The smallest hash of every `width` consecutive ones, once each; of all of them when they are fewer."""
    n = F.size(grams)
    mins = F.transform(F.sequence(F.lit(1), n - width + 1), lambda i: F.array_min(F.slice(F.col(grams), i, F.lit(width))))
    return F.array_distinct(F.when(n >= width, mins).when(n > 0, F.array(F.array_min(grams))).otherwise(F.array().cast("array<bigint>")))


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct items with words, each with a key; an item without id has no name to report, but its words count."""
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item_id"),
                            F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    items = rows.select("item_id", words_of("text").alias("item_words")).filter(F.size("item_words") > 0).distinct()
    return items.withColumn("item", F.xxhash64("item_id", "item_words"))


def _runs(equal: str, least: F.Column) -> F.Column:
    """[from, to) of the runs of at least `least` ones in a string of zeros and ones."""
    empty = "CAST(array() AS array<struct<a:int,b:int>>)"
    return F.aggregate(
        F.split(equal, "0"), F.expr(f"named_struct('at', 0, 'out', {empty})"),
        lambda acc, part: F.struct(
            (acc["at"] + F.length(part) + 1).alias("at"),
            F.when(F.length(part) >= least, F.concat(acc["out"], F.array(F.struct(acc["at"].alias("a"), (acc["at"] + F.length(part)).alias("b")))))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"])


def shared_spans(docs: DataFrame, benchmark: DataFrame, window: int = 13, gram: int = 6, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The words of every document (key, doc_id, n_words), and the spans (key, item_id, a, b) it shares with an item.

    A span is a longest run of words [a, b) that stand in the item side by side, at least `window` of them, or the whole
    item when that has fewer words. Any `window` shared words hold `window - gram + 1` consecutive grams, whose smallest is
    a fingerprint on both sides, so none is missed. Items of fewer words are looked up by hashes of that many words
    instead. Documents are reduced to fingerprints in place; only those that meet an item's are looked at again.
    NULL texts have no words; rows equal in id and text are one document; items without words match nothing, and spans of items without id have
    a NULL item_id.
    """
    df = documents(docs, id_col, text_col).select(row_key().alias("key"), "doc_id", words_of("text").alias("words"))
    items = materialise(_items(benchmark, item_col, item_text).withColumn("n_item", F.size("item_words")), "items")
    short = sorted(r[0] for r in items.filter(F.col("n_item") < window).select("n_item").distinct().collect())  # below `window` numbers
    width = window - gram + 1
    prints = df.withColumn("grams", _grams("words", gram)).withColumn("prints", _winnowed("grams", width))
    for n in short:
        prints = prints.withColumn("prints", F.concat("prints", F.array_distinct(_grams("words", n))))
    base = materialise(prints.select("key", "doc_id", F.size("words").cast("long").alias("n_words"), "prints"), "prints")

    long_items = items.filter(F.col("n_item") >= window).withColumn("grams", _grams("item_words", gram))
    known = long_items.select("item", F.lit(gram).alias("k"), F.explode(_winnowed("grams", width)).alias("print"))
    placed = long_items.select("item", F.posexplode("grams").alias("at_item", "print"))
    for n in short:
        whole = items.filter(F.col("n_item") == n).select("item", F.lit(n).alias("k"), F.xxhash64(
            *[F.get("item_words", F.lit(j)) for j in range(n)]).alias("print"))
        known = known.unionByName(whole)
        placed = placed.unionByName(whole.select("item", F.lit(0).alias("at_item"), "print"))
    known = materialise(known, "item-prints")
    # A print of an item stands where any of its grams has that hash.
    places = known.select("item", "k", "print").distinct().join(placed, ["item", "print"])
    places = materialise(places, "item-places")

    met = joined(base.select("key", F.explode("prints").alias("print")), known.select("print").distinct(), ["print"], "left_semi")
    found = materialise(met.select("key").distinct(), "met")
    again = joined(df, found, ["key"], "left_semi").dropDuplicates(["key"])
    again = materialise(again.select("key", "words"), "met-words")
    sizes = [gram, *[n for n in short if n != gram]]
    grams = None
    for k in sizes:
        part = again.select("key", F.lit(k).alias("k"), F.posexplode(_grams("words", k)).alias("at_doc", "print"))
        grams = part if grams is None else grams.unionByName(part)
    pairs = joined(grams, places, ["k", "print"], "inner").select("key", "item", (F.col("at_doc") - F.col("at_item")).alias("shift")).distinct()
    texts = pairs.join(again, "key")
    texts = joined(texts, items, ["item"], "inner")
    from_doc, from_item = F.greatest("shift", F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    n = F.least(F.size("words") - from_doc, F.col("n_item") - from_item)
    equal = F.array_join(F.zip_with(F.slice("words", from_doc + 1, n), F.slice("item_words", from_item + 1, n),
                                    lambda a, b: F.when(a == b, "1").otherwise("0")), "")
    runs = texts.select("key", "item_id", from_doc.alias("from_doc"), F.least(F.lit(window), F.col("n_item")).alias("least"), equal.alias("equal"))
    spans = (runs.select("key", "item_id", "from_doc", F.explode(_runs("equal", F.col("least"))).alias("r"))
             .select("key", "item_id", (F.col("from_doc") + F.col("r.a")).alias("a"), (F.col("from_doc") + F.col("r.b")).alias("b")).distinct())
    return base.select("key", "doc_id", "n_words"), materialise(spans, "spans")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20, **columns) -> DataFrame:
    """key, doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated of every document.

    A word is hit when it lies in a shared span; a document is contaminated from one hit word in `one_in` on. Overlapping
    spans count once. Items without id count as one item and have no name in `items`. A document without words has no hits. An empty benchmark contaminates nothing.
    """
    counts, spans = shared_spans(docs, benchmark, window, **columns)
    before = Window.partitionBy("key").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce(F.max("b").over(before), F.lit(0))))
    hit = spans.select("key", "a", "b").distinct().withColumn("new", new).groupBy("key").agg(F.sum("new").alias("n_hit"))
    named = spans.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max(F.col("item_id").isNull().cast("int")).alias("unnamed"))
    both = counts.join(hit.join(named, "key"), "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return both.select("key", "doc_id", "n_words", n_hit.alias("n_hit"), (F.size(items) + F.coalesce("unnamed", F.lit(0))).cast("long").alias("n_items"), items.alias("items"),
                       ((n_hit > 0) & (one_in * n_hit >= F.col("n_words"))).alias("contaminated"))
