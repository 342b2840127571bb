"""Lines that repeat across documents, exactly or but for one word: deletion neighbourhoods. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesml.llm.common import documents, joined, keyed, row_key
from seriesml.session import materialise

#: Shorter lines are kept whatever they say; a changed word counts as an edit only in lines of MIN_WORDS or more.
MIN_CHARS, MIN_WORDS = 32, 8
BLANKS = r"[\x20\x09-\x0D]+"


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    rows = docs.select(row_key().alias("key"), "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.filter(F.length("line") >= min_chars).withColumn("words", F.array_remove(F.split("line", BLANKS), ""))


def _hashed(lines: DataFrame) -> DataFrame:
    said = F.array_join("words", " ")
    return lines.withColumns({"h1": F.xxhash64(said), "h2": F.xxhash64(said, F.lit(1))})


def _halves() -> F.Column:
    """Hashes of the first and last words that survive when another line has one word more, less or changed.

    With m the smaller of two word counts, the edit spares the first m / 2 words or the last m - m / 2.
    """
    n = F.size("words")
    parts = []
    for m in (n, n - 1):
        k = F.floor(m / 2).cast("int")
        parts.append(F.xxhash64(F.lit("first"), F.array_join(F.slice("words", F.lit(1), k), " ")))
        parts.append(F.xxhash64(F.lit("last"), F.array_join(F.slice("words", n - (m - k) + 1, m - k), " ")))
    return F.array_distinct(F.array(*parts))


def _within_one_edit(a: str, b: str) -> F.Column:
    """Whether two arrays of words are equal but for one word added, left out or changed."""
    n, m = F.size(a), F.size(b)
    least = F.least(n, m)

    def common(x, y):
        same = F.zip_with(F.slice(x, F.lit(1), least), F.slice(y, F.lit(1), least), lambda p, q: p == q)
        return F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, least)
    return common(F.col(a), F.col(b)) + common(F.reverse(a), F.reverse(b)) >= F.greatest(n, m) - 1


def near_lines(docs: DataFrame, distinct_lines: DataFrame, min_chars: int, min_words: int) -> DataFrame:
    """h1, h2 of the distinct lines that are one edit away from an earlier line.

    `distinct_lines` (written already) has h1, h2, first (doc_id, pos, key of the earliest) and halves of each line. Lines which
    share no half with another one cannot be within the bound and emit no variants. The others emit, for each
    word, the line without it as a hash: equal hashes at the same place of equally long lines are a changed word, and a hash
    equal to a whole line is an added word. Hashes are counted alone first, and lines meet only where one repeats. Only the
    earliest line of each hash is met, so a group gives as many rows as it has lines. What meets is compared word by word.
    """
    halves = distinct_lines.filter(F.size("halves") > 0).select("h1", "h2", F.explode("halves").alias("half"))
    shared = materialise(halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half"), "halves")
    some = joined(halves, shared, ["half"], "left_semi").select("h1", "h2").distinct()
    chosen = materialise(distinct_lines.join(some, ["h1", "h2"], "left_semi").select("h1", "h2", F.col("first.*")), "near-lines")
    rows = _lines(docs, min_chars).select("key", "pos", "words")
    texts = joined(rows, chosen, ["key", "pos"], "inner").dropDuplicates(["h1", "h2"])
    texts = materialise(texts.select("h1", "h2", F.struct("doc_id", "pos", "key", "h1", "h2").alias("at"), "words"), "near-texts")

    line = Window.partitionBy("h1", "h2")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = texts.select("h1", "h2", "at", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    each = each.withColumns({"here": F.xxhash64("word", "i"), "moved": F.xxhash64("word", F.col("i") - 1)})
    each = each.withColumns({"front": F.bit_xor("here").over(upto), "back": F.bit_xor("moved").over(upto), "all": F.bit_xor("moved").over(line)})
    variant = F.col("front").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("all").bitwiseXOR(F.col("back")))
    variants = each.select("h1", "h2", "at", "n", "i", variant.alias("variant"), F.when(F.col("i") == F.col("n") - 1, F.col("front")).alias("whole"))
    variants = materialise(variants, "variants")

    def repeated(rows, keys, counts, wanted):
        """The rows whose `keys` pass `wanted` by their counts; only keys and counts are shuffled, and rows when keys are many."""
        groups = materialise(rows.groupBy(*keys).agg(*counts).filter(wanted).select(*keys), "repeated-variants")
        return materialise(joined(rows, groups, keys, "left_semi"), "met-variants")

    same = repeated(variants.select("variant", "i", "n", "at"), ["variant", "i", "n"], [F.count("*").alias("several")], "several > 1")
    changed = same.groupBy("variant", "i", "n").agg(F.min("at").alias("earliest"))
    pairs = same.join(changed, ["variant", "i", "n"]).select("at", "earliest")
    shorter = variants.select("variant", "at", F.lit(False).alias("is_whole")).unionByName(
        variants.filter(F.col("whole").isNotNull()).select(F.col("whole").alias("variant"), "at", F.lit(True).alias("is_whole")))
    shorter = repeated(shorter, ["variant"], [F.max("is_whole").alias("any_whole"), F.min("is_whole").alias("all_whole")], "any_whole AND NOT all_whole")
    met = shorter.groupBy("variant").agg(F.min(F.when(F.col("is_whole"), F.col("at"))).alias("first_whole"),
                                         F.min(F.when(~F.col("is_whole"), F.col("at"))).alias("first_cut"))
    other = F.when(F.col("is_whole"), F.col("first_cut")).otherwise(F.col("first_whole"))
    pairs = pairs.unionByName(shorter.join(met, "variant").select("at", other.alias("earliest")))
    pairs = pairs.filter(F.col("earliest") < F.col("at")).select(
        F.col("at.h1").alias("h1"), F.col("at.h2").alias("h2"), F.col("earliest.h1").alias("e1"), F.col("earliest.h2").alias("e2")).distinct()
    words = texts.select("h1", "h2", "words")
    both = pairs.join(words, ["h1", "h2"]).join(words.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("words").alias("before")), ["e1", "e2"])
    return both.filter(_within_one_edit("words", "before")).select("h1", "h2").distinct()


def repeated_lines(docs: DataFrame, edits: int = 1, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, doc_id, removed (positions of lines, from 0), n_near of the documents that lose lines.

    Lines of at least `min_chars` characters are compared by their words. Of lines with the same words the first stays, by
    document id (NULL first), line and row key; with `edits` 1 a line also goes when an earlier line has one word more,
    less or changed, both having `min_words` words at least. `edits` 0 compares exactly.
    Rows equal in id and text are one document and lose the same lines. NULL or empty texts have none.
    """
    if edits not in (0, 1):
        raise ValueError("edits is 0 or 1")
    df = documents(docs, id_col, text_col)
    empty = F.array().cast("array<bigint>")
    enough = F.size("words") >= min_words if edits else F.lit(False)
    lines = _hashed(_lines(df, min_chars)).select("key", "doc_id", "pos", "h1", "h2", F.when(enough, _halves()).otherwise(empty).alias("halves"))
    lines = materialise(lines, "lines")
    first = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "pos", "key")).alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves"))
    first = materialise(first, "distinct-lines")  # lines of the same words have the same halves
    if edits:
        near = near_lines(df, first, min_chars, min_words).withColumn("near", F.lit(True))
        first = first.join(near, ["h1", "h2"], "left").withColumn("near", F.coalesce("near", F.lit(False)))
    else:
        first = first.withColumn("near", F.lit(False))
    several = materialise(first.filter("n > 1 OR near").drop("n", "halves"), "repeated")
    here = F.struct("doc_id", "pos", "key")
    gone = joined(lines.drop("halves"), several, ["h1", "h2"], "inner").filter(F.col("near") | (here != F.col("first")))
    return gone.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set("pos")).alias("removed"),
                                   F.count_if(F.col("near") & (here == F.col("first"))).alias("n_near"))


def without_lines(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the lines of `removed` cut out of the text; all rows and columns stay. A text that loses all is empty."""
    rows, key = keyed(docs, id_col, text_col)
    positions = "removed_lines"
    while positions in rows.columns:
        positions += "_"
    right = removed.select(F.col("key").alias(key), F.col("removed").alias(positions))
    text = F.col(f"`{text_col}`")
    said = F.transform(F.array(F.split(text, "\n")), lambda lines: F.array_join(F.transform(  # an array of one: the text is split once
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(positions)), lambda i: F.get(lines, i)), "\n"))[0]
    return rows.join(right, key, "left").select(*[
        F.when(F.col(positions).isNull(), text).otherwise(said).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
