"""Language of a text: piece probabilities of each language over a fixed public vocabulary, summed over all segmentations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesml.llm.common import documents, slices
from seriesml.session import materialise

#: Words are runs of letters in lower case behind the vocabulary's mark of a word's start.
_WORD, _MARK = re.compile(r"[^\W\d_]+"), "▁"
#: The share of each language's probability that is spread over all pieces alike.
SPREAD = 1e-3
#: Words whose sums a Python worker keeps.
KEPT_WORDS = 200_000
UNDETERMINED = "und"


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece file in the order of their ids; bytes stand as <0x00> to <0xFF>."""
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Pieces:
    """Finds all pieces of many words at once by a trie whose edges are a sorted array. A character that is no piece is the row
    of its bytes' pieces, one edge for each byte.
    """

    def __init__(self, pieces: list[str]):
        self.number: dict[str, int] = {}
        for i, p in enumerate(pieces):
            self.number.setdefault(p, i)
        nodes = {"": 0}
        for p in self.number:
            for n in range(1, len(p) + 1):
                nodes.setdefault(p[:n], len(nodes))
        keys = np.array([nodes[q[:-1]] << 21 | ord(q[-1]) for q in nodes if q] or [-1], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array([nodes[q] for q in nodes if q] or [0], dtype=np.int64)[order]
        self.piece = np.full(len(nodes), -1, dtype=np.int64)
        self.piece[[nodes[p] for p in self.number]] = list(self.number.values())
        self.bytes = [self.number.get(f"<0x{b:02X}>", -1) for b in range(256)]

    def lattice(self, words: list[str]) -> Lattice:
        text = "".join([f"{_MARK}{w}\0" for w in words])
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        last = np.flatnonzero(codes == 0)  # the place after a word's last character
        first = np.concatenate([[0], last[:-1] + 1]).astype(np.int64)[:len(last)]
        word_of = np.repeat(np.arange(len(last)), last - first + 1)
        begin = at = np.flatnonzero(codes)
        node, whole = np.zeros(len(at), dtype=np.int64), np.zeros(len(codes), dtype=bool)
        parts: list[tuple] = []
        while len(at):
            key = node << 21 | codes[at]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[place] == key
            begin, at, node = begin[found], at[found] + 1, self.child[place[found]]
            piece = self.piece[node]
            hit = piece >= 0
            if not parts:
                whole[begin[hit]] = True
            parts.append((begin[hit], at[hit], piece[hit]))
        source, target, piece = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, dtype=np.int64)] * 3
        word = word_of[source]
        depth = (target - first[word]).astype(float)
        sources, targets, pieces, depths, owners, nodes = [], [], [], [], [], len(codes)
        for i in np.flatnonzero((codes != 0) & ~whole).tolist():  # through nodes of its own between the two places
            spelled = text[i].encode("utf-8", "surrogatepass")
            inner = [i, *range(nodes, nodes + len(spelled) - 1), i + 1]
            nodes += len(spelled) - 1
            w = int(word_of[i])
            sources += inner[:-1]
            targets += inner[1:]
            pieces += [self.bytes[b] for b in spelled]
            depths += [i - int(first[w]) + (x + 1) / len(spelled) for x in range(len(spelled))]
            owners += [w] * len(spelled)
        more = [np.array(x, dtype=np.int64) for x in (sources, targets, pieces, owners)]
        arrays = [np.concatenate(x) for x in zip((source, target, piece, word), more)]
        return Lattice(*arrays, first, last, np.concatenate([depth, np.array(depths)]), nodes)


class Lattice:
    """The pieces of many words as edges between places, in steps of equal depth."""

    def __init__(self, source, target, piece, word, first, last, depth, nodes):
        order = np.lexsort((target, depth))
        self.source, self.target, self.piece, self.word = source[order], target[order], piece[order], word[order]
        self.first, self.last, self.nodes, depth = first, last, nodes, depth[order]
        self.cuts = [0, *(np.flatnonzero(depth[1:] != depth[:-1]) + 1).tolist(), len(depth)] if len(depth) else [0]

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        """(nodes, columns): log of the sum over all segmentations up to each place; `log_p` has a row for each edge."""
        alpha = np.full((self.nodes, log_p.shape[1]), -np.inf)
        alpha[self.first] = 0.0
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            target = self.target[a:b]
            starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
            alpha[target[starts]] = _log_sums(alpha[self.source[a:b]] + log_p[a:b], starts)
        return alpha

    def backward(self, log_p: np.ndarray) -> np.ndarray:
        """The same from each place to the end of its word."""
        beta = np.full((self.nodes, log_p.shape[1]), -np.inf)
        beta[self.last] = 0.0
        # In descending depth all edges out of a place come after those into its successors; each edge is one term.
        for a, b in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            source, value = self.source[a:b], beta[self.target[a:b]] + log_p[a:b]
            order = np.argsort(source, kind="stable")
            places, starts = np.unique(source[order], return_index=True)
            beta[places] = np.logaddexp(beta[places], _log_sums(value[order], starts))
        return beta

    def log_likelihood(self, table: np.ndarray) -> np.ndarray:
        """(words, languages) of a table of log-probabilities (pieces, languages)."""
        return self.forward(_rows(table, self.piece))[self.last]


def _rows(table: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Bytes that the vocabulary does not have cost the least probability."""
    return np.where((piece >= 0)[:, None], table[piece], table.min(axis=0, initial=0.0))


def _log_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(values, starts, axis=0)
    size = np.diff(np.append(starts, len(values)))
    return top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, size, axis=0)), starts, axis=0))


@dataclass(frozen=True)
class Languages:
    """Names, and log-probabilities (pieces, languages); the vocabulary is the caller's."""

    names: list[str]
    log_p: np.ndarray


def fold(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 4; 2 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def sent():
        keys = list(counts)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                           pa.array(list(counts.values()), pa.int64())], names=["word", "language", "n"])
    for batch in slices(batches, 0):
        for text, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update((w, language) for w in words_of(text))
        if len(counts) > KEPT_WORDS:
            yield sent()
            counts.clear()
    yield sent()


def _expected(pieces: list[str], table: np.ndarray | None, languages: int):
    """Expected numbers of each piece in each language, given the words' counts; without a table every edge counts once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, total = Pieces(pieces), np.zeros(len(pieces) * languages)
        for batch in batches:
            for a in range(0, batch.num_rows, 20_000):
                part = batch.slice(a, 20_000)
                words, language, n = part.column(0).to_pylist(), part.column(1).to_numpy(), part.column(2).to_numpy()
                net = finder.lattice(words)
                word = net.word
                weight = n[word].astype(float)
                if table is not None:
                    log_p = _rows(table, net.piece)[np.arange(len(net.piece)), language[word]][:, None]
                    alpha, beta = net.forward(log_p), net.backward(log_p)
                    weight *= np.exp(alpha[net.source] + log_p + beta[net.target] - alpha[net.last][word])[:, 0]
                fine = net.piece >= 0
                total += np.bincount(net.piece[fine] * languages + language[word][fine], weights=weight[fine], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])
    return run


def fit_languages(docs: DataFrame, pieces: list[str], per_language: int = 1_500, rounds: int = 4, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Piece probabilities of every language by expectation-maximisation over all segmentations of the sample's words.

    Learnt from documents outside the held-out fold with a language, about `per_language` of each, chosen by a hash of the
    id. Words are counted by language in Spark; a round sums expected numbers of pieces over tasks, and a number for each
    piece and language (the vocabulary's size times the languages) reaches the driver. Documents without an id or a language are not
    learnt from; without any, there are no languages. Sums over tasks depend on their order in the last digits only, and
    tables are rounded to ten digits.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.filter((fold() != 2) & F.col("lang").isNotNull())
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    names = [r["lang"] for r in found]
    if not names:
        return Languages([], np.zeros((len(pieces), 0)))
    spark = docs.sparkSession
    # A row for each language.
    shares = spark.createDataFrame([(r["lang"], i, per_language / r["n"]) for i, r in enumerate(found)], "lang string, language int, share double")
    chosen = rows.join(F.broadcast(shares), "lang").filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    counted = chosen.select("text", "language").mapInArrow(_sample_words, "word string, language int, n long")
    counted = materialise(counted.groupBy("word", "language").agg(F.sum("n").alias("n")).repartition(4 * spark.sparkContext.defaultParallelism, "word"), "words")
    table = None
    for _ in range(rounds + 1):
        sums = counted.mapInArrow(_expected(pieces, table, len(names)), "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
        total = np.zeros(len(pieces) * len(names))
        for r in sums:
            total[r["cell"]] = r["n"]
        total = total.reshape(-1, len(names))
        share = total / np.maximum(total.sum(axis=0), 1e-300)
        table = np.round(np.log((1 - SPREAD) * share + SPREAD / len(pieces)), 10)
    return Languages(names, table)


class _Sums:
    """Log-probabilities of words in all languages, kept between slices."""

    def __init__(self, model: Languages, pieces: list[str]):
        self.finder, self.model, self.row = Pieces(pieces), model, {}
        self.table = np.zeros((0, len(model.names)))

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.row) > KEPT_WORDS:
            self.row, self.table = {}, self.table[:0]
        new = [w for w in dict.fromkeys(words) if w not in self.row]
        made = [self.table]
        for a in range(0, len(new), 20_000):
            part = new[a:a + 20_000]
            made.append(self.finder.lattice(part).log_likelihood(self.model.log_p))
        self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
        self.table = np.concatenate(made)
        return self.table[np.fromiter(map(self.row.__getitem__, words), dtype=np.int64, count=len(words))]


def posteriors(model: Languages, sums: np.ndarray) -> np.ndarray:
    p = np.exp(sums - sums.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def languages_of(docs: DataFrame, model: Languages, pieces: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the posterior of that language, all alike before), n_words of every row, without a shuffle.

    The sum over all segmentations of a text is the product of its words' sums, since no piece crosses a word's start. A text
    that is NULL or has no letter is `und` with a score of 0; so is every text when no language was learnt. Of languages
    with the same score the first by name is taken. Repeated rows and NULL ids are rows like any other.
    """
    df = documents(docs, id_col, text_col)
    kind = dict(df.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(model, pieces)
        for batch in slices(batches, 1):
            said = [words_of(t) for t in batch.column(1).to_pylist()]
            size = np.array([len(w) for w in said], dtype=np.int64)
            name, score = [UNDETERMINED] * len(said), np.zeros(len(said))
            full = np.flatnonzero(size)
            if len(full) and model.names:
                logs = sums.of([w for words in said for w in words])
                p = posteriors(model, np.add.reduceat(logs, (np.cumsum(size) - size)[full], axis=0))
                best = p.argmax(axis=1)
                score[full] = p[np.arange(len(full)), best]
                for i, b in zip(full.tolist(), best.tolist()):
                    name[i] = model.names[b]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(name), pa.array(score), pa.array(size)],
                                             names=["doc_id", "lang_pred", "score", "n_words"])
    return df.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_words long")
