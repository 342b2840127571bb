"""Near-duplicate documents: ProbMinHash signatures of weighted shingles, banding, exact verification, classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesml.llm.common import documents, joined, keyed, row_key, slices
from seriesml.session import materialise

#: 25 bands of 5 registers: two documents of similarity 0.8 meet in none with a probability of 5e-5, of 0.9 with 2e-10.
BANDS, ROWS = 25, 5
SHINGLE, SIMILARITY = 5, 0.8
#: The white space that str.split() knows.
BLANKS = r"[\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
#: A band that still holds several classes is cut into blocks of so many members, and every two blocks meet in a task.
BLOCK = 500
#: Registers in which two signatures agree before the texts are compared: of 125, two documents of similarity 0.8 agree in fewer
#: with a probability of 1e-5.
AGREE = 80
#: Shingles of texts that a task keeps while two blocks meet.
KEPT_SHINGLES = 2_000_000
#: Shingles that are signed at a time, beside those of one document.
SIGNED_TOGETHER = 50_000
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit numbers (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLIERS[1]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLIERS[2]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Word to a 64-bit hash; the memory is bounded between batches."""

    def __missing__(self, word: str) -> int:
        import xxhash
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


_HASHES = _WordHashes()


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles of `size` words in lower case, and how often each occurs.

    A text of fewer words is one shingle; a text without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(_HASHES) > 300_000:
        _HASHES.clear()
    n = max(1, len(hashes) - size + 1)
    mixed = np.full(n, len(hashes) if len(hashes) < size else size, dtype=np.uint64)
    for j in range(min(size, len(hashes))):
        mixed = _mixed(mixed * _MULTIPLIERS[0] + hashes[j:j + n])
    return np.unique(mixed, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash of weighted sets, a row each: for each register the element whose process reaches it first.

    Each element is a Poisson process with its weight as rate, its arrivals thrown at registers by a hash of the element
    alone. Arrivals are drawn in rounds for all sets together; an element ends as soon as its next arrival is later than
    the earliest of every register of its set. Two signatures agree in a register with the probability Jaccard similarity
    of the weighted sets. Sets are not empty.
    """
    elements, weights = (np.concatenate(x) for x in zip(*sets))
    owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    times, owners = np.full(len(sets) * size, np.inf), np.zeros(len(sets) * size, dtype=np.uint64)
    at = np.zeros(len(elements))
    draw = 0
    while len(elements):
        bits = _mixed(elements + np.uint64((2 * draw + 1) * int(_MULTIPLIERS[0]) % 2 ** 64))
        unit = ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
        at = at - np.log(unit) / weights
        register = owner * size + (_mixed(bits + _MULTIPLIERS[1]) % np.uint64(size)).astype(np.int64)
        np.minimum.at(times, register, at)
        first = np.flatnonzero(at == times[register])
        first = first[np.argsort(elements[first])[::-1]]  # of equal times the smaller element is written last
        owners[register[first]] = elements[first]
        live = at < times.reshape(len(sets), size).max(axis=1)[owner]
        elements, weights, owner, at = elements[live], weights[live], owner[live], at[live]
        draw += 1
    return owners.reshape(len(sets), size)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact: the sum over shared elements i of 1 / sum_j max(a_j / a_i, b_j / b_i); 0 when nothing is shared.

    For the shared element i with ratio r = a_i / b_i, elements of a larger ratio count by a and the others by b.
    """
    shared, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    wa, wb = a[1][ia].astype(float), b[1][ib].astype(float)
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    up_to_b = np.cumsum(wb)  # ratios at most r; equal ratios count the same either way
    above_a = wa.sum() - np.cumsum(wa)
    return float((1.0 / ((only_a + above_a) / wa + (only_b + up_to_b) / wb)).sum())


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows, bands, orders, signed, sets = [], [], [], [], []

            def sign():
                registers = signatures(sets).reshape(-1, BANDS, ROWS)
                signed.extend(x.tobytes() for x in (_mixed(registers) >> np.uint64(48)).astype(np.uint16).reshape(-1, BANDS * ROWS))
                mixed = np.full(registers.shape[:2], BANDS * ROWS, dtype=np.uint64)
                for j in range(ROWS):
                    mixed = _mixed(mixed * _MULTIPLIERS[0] + registers[:, :, j])
                bands.append(mixed.ravel().view(np.int64))
                # The next registers of each band, in 16 bits each: like documents of a band are neighbours in this order.
                top = (_mixed(np.roll(registers, -1, axis=1)[:, :, :4]) >> np.uint64(48)) << np.array([48, 32, 16, 0], dtype=np.uint64)
                orders.append(np.bitwise_or.reduce(top, axis=2).ravel().view(np.int64))
                sets.clear()
            held = 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                made = shingles(text, size)
                if len(made[0]):
                    rows.append(i)
                    sets.append(made)
                    held += len(made[0])
                    if held > SIGNED_TOGETHER:
                        sign()
                        held = 0
            if sets:
                sign()
            flat = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (bands, orders)]
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * BANDS)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in flat]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *lists, pa.array(signed, pa.binary())],
                                             names=["key", "bands", "orders", "signature"])
        _HASHES.clear()  # the worker lives on
    return run


def _verified(size: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None  # pairs come sorted by their first document
        for batch in batches:
            a, b, text_a, text_b = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for i in range(len(a)):
                if a[i] != last:
                    last, known = a[i], shingles(text_a[i], size)
                keep.append(probability_jaccard(known, shingles(text_b[i], size)) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])
        _HASHES.clear()
    return run


def _side_by_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows in a row with the same band and hash; the first (edge 1) and the last row (2) of a task without b."""
    def made(rows, a, b, edge):
        return pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                           pa.array(edge, pa.int64())], names=["band", "hash", "turn", "a", "b", "edge"])
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(3).to_numpy()
        if last is None:
            first = batch.slice(0, 1)
            yield made(first, [key[0]], [None], [1])
        else:
            batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            key = batch.column(3).to_numpy()
        last = batch.slice(batch.num_rows - 1, 1)
        band, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        at = np.flatnonzero((band[1:] == band[:-1]) & (hashes[1:] == hashes[:-1]) & (key[1:] != key[:-1])) + 1
        rows = batch.take(pa.array(at))
        yield made(rows, key[at], key[at - 1], np.zeros(len(at), dtype=np.int64))
    if last is not None:
        yield made(last, last.column(3).to_numpy(), [None], [2])


def neighbours(members: DataFrame) -> DataFrame:
    """a < b: documents side by side in their band in the order of `turn` and key, as distinct pairs.

    The order is dealt by ranges over all its columns, so one large band is cut over many tasks; the rows at the cuts, two
    for each task, are matched afterwards.
    """
    order = ["band", "hash", "turn", "key"]
    ordered = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    made = materialise(ordered.mapInArrow(_side_by_side, "band int, hash long, turn long, a long, b long, edge long"), "neighbours")
    cuts = Window.partitionBy("band", "hash").orderBy("turn", "a", "edge")
    met = made.filter("edge > 0").withColumns({"b": F.lag("a").over(cuts), "before": F.lag("edge").over(cuts)})
    pairs = made.filter("edge = 0").unionByName(met.filter("edge = 1 AND before = 2").drop("before")).filter("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(links: DataFrame) -> DataFrame:
    """key, root of every document with a link: the smallest key that it reaches over `links` (a, b; written already).

    Each round every document takes the smallest root among its neighbours' and its root's, and roots are followed to
    their own roots, so the number of rounds grows with the logarithm of the longest chain. Rounds end when the two ends of
    every link have the same root. Each round is one shuffle while the roots are few enough to broadcast.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "key"), "roots")
    n = roots.count()
    while True:
        of = lambda c, r: roots.select(F.col("key").alias(c), F.col("root").alias(r))
        near = joined(both, of("b", "root"), ["b"], "inner", n).select(F.col("a").alias("key"), "root")
        if joined(near, of("key", "own"), ["key"], "inner", n).filter("root <> own").isEmpty():
            return roots
        # What a document has found is told to its root as well (hooking), and its root's root is taken over (shortcut).
        offered = joined(near, of("key", "old"), ["key"], "inner", n).filter("root < old").select(F.col("old").alias("key"), "root")
        best = materialise(roots.unionByName(near).unionByName(offered).groupBy("key").agg(F.min("root").alias("root")), "roots")
        up = best.select(F.col("key").alias("root"), F.col("root").alias("above"))
        roots = materialise(joined(best, up, ["root"], "left", n).select("key", F.least("root", F.coalesce("above", "root")).alias("root")), "roots")


def still_apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """key, band, hash, root of the members of bands that hold two classes or more, and the number of blocks of the band."""
    placed = joined(members.select("key", "band", "hash"), roots, ["key"], "inner")
    several = placed.groupBy("band", "hash").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    several = materialise(several.filter("low < high").select("band", "hash", "blocks"), "open")
    return materialise(joined(placed, several, ["band", "hash"], "inner"), "apart")


def _meet(size: int, similarity: float):
    """Links between members of different classes of two blocks of a band, or of one block: enough of them to join what belongs together.

    Signatures (16 bits a register) are compared first; a pair that shares several bands is looked at in the first of them
    only. Pairs are taken from the most alike on, and those that links found here have joined already are left out.
    """
    def run(group: tuple, table: pa.Table) -> pa.Table:
        band, low, high = group[0].as_py(), group[2].as_py(), group[3].as_py()
        table = table.sort_by("key")
        key, block = table.column("key").to_numpy(), table.column("block").to_numpy()
        root, texts = table.column("root").to_pylist(), table.column("text")
        sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint16).reshape(len(key), BANDS, ROWS)
        joined_to = {r: r for r in root}
        numbers = np.unique(table.column("root").to_numpy(), return_inverse=True)[1]

        def find(r):
            while joined_to[r] != r:
                joined_to[r] = r = joined_to[joined_to[r]]
            return r
        known, held, found = {}, 0, []

        def said(i):
            nonlocal held
            if i not in known:
                if held > KEPT_SHINGLES:
                    known.clear()
                    held = 0
                known[i] = shingles(texts[i].as_py(), size)
                held += len(known[i][0])
            return known[i]
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        flat = sign.reshape(len(key), -1)
        for a in range(0, len(left), 50):
            part = left[a:a + 50]
            agree = (flat[part][:, None, :] == flat[right][None, :, :]).sum(axis=2)
            wanted = (agree >= AGREE) & (numbers[part][:, None] != numbers[right][None, :])
            if low == high:
                wanted &= part[:, None] < right[None, :]
            i, j = np.nonzero(wanted)
            if not len(i):
                continue
            shared = (sign[part[i]] == sign[right[j]]).all(axis=2)
            mine = shared.argmax(axis=1) == band
            i, j = i[mine], j[mine]
            for n in np.argsort(-agree[i, j], kind="stable").tolist():
                x, y = int(part[i[n]]), int(right[j[n]])
                ra, rb = find(root[x]), find(root[y])
                if ra != rb and probability_jaccard(said(x), said(y)) >= similarity:
                    joined_to[max(ra, rb)] = min(ra, rb)
                    found.append((int(key[x]), int(key[y])))
        _HASHES.clear()
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})
    return run


def meetings(apart: DataFrame, signed: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Links (a, b) that join the classes of every open band. `apart` is what still_apart returns.

    A band of many members is cut into blocks by a hash of the key; each member goes to the meetings of its block, so a task
    holds two blocks of texts and a band of n members takes (n / BLOCK) squared of them. What comes out has fewer rows than
    each meeting has members.
    """
    asked = apart.select("key").distinct()
    told = signed.select("key", "signature").join(asked, "key", "left_semi").join(texts, "key")
    placed = apart.withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    rows = spread.select("band", "hash", "low", "high", "block", "key", "root").join(told, "key")
    return rows.groupBy("band", "hash", "low", "high").applyInArrow(_meet(size, similarity), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """key, doc_id, class_key, class_id (key and id of the first document of the class), n_class of every row of `docs`.

    Texts with the same words in the same order are one from the start and are signed once. Documents that share a band are
    compared in three rounds: with the first of the band; with the document before them in the order of the following
    registers (near copies of one text are neighbours in many of the bands); and, in bands that still hold several classes,
    with every member of another class whose signature is alike enough, in meetings of blocks that return only the links
    that join classes. Bands of one class are done. Candidates count as links when the exact probability Jaccard
    similarity of their shingles, weighted by their counts, reaches `similarity`; classes are what links connect. NULL and empty texts have no words and stand
    alone, each row by itself; NULL ids come first, so class_id is NULL where a NULL id is the first of a class.
    """
    df = documents(docs, id_col, text_col)
    said = F.array_join(F.array_remove(F.split(F.lower("text"), BLANKS), ""), " ")
    rows = materialise(df.select(row_key().alias("key"), "doc_id", F.xxhash64(said).alias("w1"), F.xxhash64(said, F.lit(1)).alias("w2"),
                                 (said != "").alias("full")), "rows")
    same = rows.filter("full").groupBy("w1", "w2").agg(F.min("key").alias("rep"), F.max("key").alias("last")).filter("rep < last")
    rep = materialise(same.select("w1", "w2", "rep"), "texts")
    several = joined(rows.filter("full"), rep, ["w1", "w2"], "inner").select("key", "rep")
    copies = materialise(several.filter("key <> rep").distinct(), "copies")
    chosen = joined(df.withColumn("key", row_key()), copies.select("key").distinct(), ["key"], "left_anti").select("key", "text")
    signed = materialise(chosen.mapInArrow(_signed(size), "key long, bands array<long>, orders array<long>, signature binary"), "bands")
    banded = signed.select("key", F.posexplode(F.arrays_zip("bands", "orders")).alias("band", "z")).select(
        "key", "band", F.col("z.bands").alias("hash"), F.col("z.orders").alias("turn"))
    busy = banded.groupBy("band", "hash").agg(F.min("key").alias("first"), F.max("key").alias("last")).filter("first < last").drop("last")
    busy = materialise(busy, "busy")
    members = materialise(joined(banded, busy, ["band", "hash"], "inner").select("key", "band", "hash", "turn", "first"), "members")
    star = members.filter("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b"))
    tried = materialise(star.distinct(), "pairs")

    def ends_of(pairs: DataFrame) -> DataFrame:
        """key of every document in a pair, and whether it is an a or a b."""
        ends = pairs.select(F.explode(F.array(*[F.struct(F.col(c).alias("key"), *[F.lit(c == x).alias(f"is_{x}") for x in "ab"]) for c in "ab"])).alias("end"))
        return materialise(ends.select("end.*").groupBy("key").agg(F.max("is_a").alias("is_a"), F.max("is_b").alias("is_b")), "ends")
    ends = ends_of(tried)  # every member of a busy band is in a pair with its first
    wanted = ends.select("key")
    texts = joined(df.withColumn("key", row_key()), wanted, ["key"], "left_semi").dropDuplicates(["key"])
    texts = materialise(texts.select("key", "text"), "candidates")

    def links(pairs: DataFrame, ends: DataFrame) -> DataFrame:
        """The pairs (a written table, with their ends) that are similar; only texts in a pair are shuffled."""
        n = ends.count()

        def said_by(c):
            asked = joined(texts, ends.filter(f"is_{c}").select("key"), ["key"], "left_semi", n)
            return asked.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}"))
        both = pairs.join(said_by("b"), "b").join(said_by("a"), "a").select("a", "b", "text_a", "text_b")
        return materialise(both.mapInArrow(_verified(size, similarity), "a long, b long"), "links")

    def merged(roots: DataFrame, found: DataFrame) -> DataFrame:
        """The roots after further links between classes."""
        of = lambda c: roots.select(F.col("key").alias(c), F.col("root").alias(f"root_{c}"))
        between = joined(joined(found, of("a"), ["a"], "inner"), of("b"), ["b"], "inner").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        between = materialise(between.filter("a <> b"), "between")
        if between.isEmpty():
            return roots
        above = classes(between).select(F.col("key").alias("root"), F.col("root").alias("above"))
        return materialise(joined(roots, above, ["root"], "left").select("key", F.coalesce("above", "root").alias("root")), "roots")

    found = links(tried, ends)
    roots = materialise(joined(wanted, classes(found), ["key"], "left").select("key", F.coalesce("root", "key").alias("root")), "roots")
    of = lambda c: roots.select(F.col("key").alias(c), F.col("root").alias(f"root_{c}"))
    chain = joined(joined(neighbours(members), of("a"), ["a"], "inner"), of("b"), ["b"], "inner").filter("root_a <> root_b").select("a", "b")
    pairs = materialise(joined(chain, tried, ["a", "b"], "left_anti"), "pairs")
    if not pairs.isEmpty():
        roots = merged(roots, links(pairs, ends_of(pairs)))
    apart = still_apart(members, roots)
    if not apart.isEmpty():
        roots = merged(roots, materialise(meetings(apart, signed, texts, size, similarity), "links"))
    of_copies = joined(copies, roots.withColumnRenamed("key", "rep"), ["rep"], "left").select("key", F.coalesce("root", "rep").alias("root"))
    roots = materialise(roots.unionByName(of_copies), "roots")
    placed = joined(rows.select("key", "doc_id"), roots, ["key"], "left").withColumn("root", F.coalesce("root", "key"))
    first = placed.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("first"), F.count("*").alias("n_class"))
    return placed.join(first, "root").select("key", "doc_id", F.col("first.key").alias("class_key"), F.col("first.doc_id").alias("class_id"), "n_class")


def one_of_each(docs: DataFrame, classed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the first document of each class only, all columns kept; of repeated rows one stays.

    `classed` is the written result of near_duplicates.
    """
    rows, key = keyed(docs, id_col, text_col)
    gone = classed.filter("key <> class_key").select(F.col("key").alias(key)).distinct()
    again = materialise(classed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias(key)), "repeated")
    left = joined(rows, gone, [key], "left_anti")
    if not again.isEmpty():
        left = joined(left, again, [key], "left_anti").unionByName(joined(left, again, [key], "left_semi").dropDuplicates([key]))
    return left.drop(key)
