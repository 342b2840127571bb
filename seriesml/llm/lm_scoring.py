"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both sides."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesml.llm.common import documents, slices
from seriesml.session import materialise

#: A token is a frequent word or a bucket of other words, numbered below VOCABULARY and predicted as DIGITS digits of base SIDE.
SIDE, DIGITS = 32, 3
VOCABULARY = SIDE ** DIGITS
#: Words with a number of their own, the most frequent ones; all others are hashed into the buckets above, each of CELLS cells.
FREQUENT, CELLS = VOCABULARY // 2, 128
BUCKETS = VOCABULARY - FREQUENT
#: Neighbours on each side, width of the network, tokens in a step.
REACH, WIDTH, STEP = 2, 8, 8192
#: Tokens whose scores are held at a time (0.4 MB), within the cache of a core; the results do not depend on it but for rounding.
HELD = 1024
#: The place outside a document (context only).
OUTSIDE = VOCABULARY
#: Words whose numbers a Python worker keeps.
KEPT_WORDS = 200_000


@dataclass
class Network:
    """The contexts' embeddings by place, the hidden bias, and the digits' outputs; a digit sees those before it."""

    embeddings: np.ndarray  # (2 * REACH, VOCABULARY + 1, WIDTH)
    bias: np.ndarray        # (WIDTH,)
    outputs: np.ndarray     # (WIDTH + 1, DIGITS * SIDE): the digits side by side
    given: np.ndarray       # (DIGITS - 1, SIDE, DIGITS * SIDE): the part of a digit in the scores of those after it

    @staticmethod
    def start(seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        return Network(*[x.astype(np.float32) for x in (
            rng.normal(0, 0.1, (2 * REACH, VOCABULARY + 1, WIDTH)), np.zeros(WIDTH), rng.normal(0, 0.1, (WIDTH + 1, DIGITS * SIDE)),
            np.zeros((DIGITS - 1, SIDE, DIGITS * SIDE)))])

    def parts(self) -> list[np.ndarray]:
        return [self.embeddings, self.bias, self.outputs, self.given]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*out)


def digits_of(ids: np.ndarray) -> np.ndarray:
    """(DIGITS, n), the highest first."""
    ids = ids.astype(np.int64)
    return np.stack([ids // SIDE ** (DIGITS - 1 - d) % SIDE for d in range(DIGITS)])


def contexts(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(2 * REACH, n): the neighbours of each token in its own document; OUTSIDE beyond its ends. `ids` are whole documents in a row."""
    padded = np.full(len(ids) + REACH * (len(sizes) + 1), OUTSIDE, dtype=np.uint16)
    at = np.arange(len(ids)) + REACH * (1 + np.repeat(np.arange(len(sizes)), sizes))
    padded[at] = ids
    return np.stack([padded[at + k] for k in (*range(-REACH, 0), *range(1, REACH + 1))])


def _hidden(net: Network, around: np.ndarray) -> np.ndarray:
    h = np.empty((around.shape[1], WIDTH + 1), dtype=net.bias.dtype)
    total = net.embeddings[0].take(around[0], axis=0)
    for k in range(1, 2 * REACH):
        total += net.embeddings[k].take(around[k], axis=0)
    total += net.bias
    np.tanh(total, out=h[:, :-1])
    h[:, -1] = 1
    return h


def _scores(net: Network, h: np.ndarray, digits: np.ndarray) -> np.ndarray:
    """(n, DIGITS, SIDE) scores, within the range of exp(); what earlier digits say of later ones is added."""
    x = h @ net.outputs
    for d in range(DIGITS - 1):
        x[:, (d + 1) * SIDE:] += net.given[d][:, (d + 1) * SIDE:].take(digits[d], axis=0)
    x = x.reshape(len(h), DIGITS, SIDE)
    if max(x.max(initial=0), -x.min(initial=0)) > 60:
        x -= x.max(axis=2, keepdims=True)
    return x


def log_probabilities(net: Network, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """log P(token | both sides) of each token."""
    out = np.empty(len(ids))
    ones = np.ones(SIDE, dtype=net.bias.dtype)
    for a in range(0, len(ids), HELD):
        b = min(a + HELD, len(ids))
        digits = digits_of(ids[a:b])
        x = _scores(net, _hidden(net, around[:, a:b]), digits)
        chosen = np.take_along_axis(x, digits.T[:, :, None], axis=2)[:, :, 0]
        out[a:b] = (chosen - np.log(np.exp(x, out=x) @ ones)).sum(axis=1)
    return out


def train(net: Network, ids: np.ndarray, around: np.ndarray, squares: list[np.ndarray], rate: float = 0.15) -> None:
    """One pass over the tokens in place, in steps with AdaGrad; `squares` are the sums kept between calls. Of the embeddings only
    those of the step's tokens are touched."""
    ones = np.ones(SIDE, dtype=net.bias.dtype)
    for a in range(0, len(ids), STEP):
        b = min(a + STEP, len(ids))
        near, n = around[:, a:b], b - a
        all_digits = digits_of(ids[a:b])
        dh = np.empty((n, WIDTH), dtype=net.bias.dtype)
        outputs, given = np.zeros_like(net.outputs), np.zeros_like(net.given)
        for c in range(0, n, HELD):
            digits = all_digits[:, c:c + HELD]
            h = _hidden(net, near[:, c:c + HELD])
            x = _scores(net, h, digits)
            np.exp(x, out=x)
            x *= (1 / (n * (x @ ones)))[:, :, None]
            rows, dx = np.arange(len(h)), x.reshape(len(h), DIGITS * SIDE)
            for d in range(DIGITS):
                dx[rows, d * SIDE + digits[d]] -= x.dtype.type(1 / n)
            dh[c:c + HELD] = (dx @ net.outputs.T)[:, :-1] * (1 - h[:, :-1] ** 2)
            outputs += h.T @ dx
            for d in range(DIGITS - 1):
                hot = np.zeros((len(h), SIDE), dtype=x.dtype)
                hot[rows, digits[d]] = 1
                given[d][:, (d + 1) * SIDE:] += hot.T @ dx[:, (d + 1) * SIDE:]
        for p, g, s in zip(net.parts()[1:], (dh.sum(axis=0), outputs, given), squares[1:]):
            s += g * g
            p -= rate * g / np.sqrt(s + 1e-30)
        for k in range(2 * REACH):
            at, g = _summed(near[k], dh)
            s = squares[0][k][at] + g * g
            squares[0][k][at] = s
            net.embeddings[k][at] -= rate * g / np.sqrt(s + 1e-30)


def _summed(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indexes that occur, and the sums of their rows."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    first = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
    return index[first], np.add.reduceat(rows[order], first, axis=0)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def cell_of(word: str) -> int:
    """The cell of a word that is not frequent; its bucket is the cell divided by CELLS."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) % (BUCKETS * CELLS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words with their cells; a task sends them on whenever it holds many."""
    counts: Counter = Counter()

    def sent():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(map(cell_of, counts), pa.int32()),
                                           pa.array(list(counts.values()), pa.int64())], names=["word", "cell", "n"])
    for batch in slices(batches, 0):
        for text in batch.column(0).to_pylist():
            counts.update(words_of(text))
        if len(counts) > 300_000:
            yield sent()
            counts = Counter()
    yield sent()


@dataclass(frozen=True)
class Vocabulary:
    """Numbers of the frequent words, and log P(cell | bucket) of all cells."""

    words: dict[str, int]
    shares: np.ndarray


def vocabulary(texts: DataFrame) -> Vocabulary:
    """The most frequent words of all texts, numbered by count and word, and the shares of the cells of all others.

    Words are counted in Spark; the frequent words and one number for each cell that occurs (BUCKETS * CELLS at most) reach the
    driver.
    """
    counts = materialise(texts.select("text").mapInArrow(_counted, "word string, cell int, n long").groupBy("word", "cell").agg(F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    cells = counts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(BUCKETS * CELLS)
    total[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    np.subtract.at(total, [r["cell"] for r in top], [r["n"] for r in top])
    total = total.reshape(BUCKETS, CELLS)
    with np.errstate(divide="ignore", invalid="ignore"):
        shares = np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32)
    return Vocabulary({r["word"]: i for i, r in enumerate(top)}, shares.ravel())


class _Numbers(dict):
    """A word to its number, or for a word that is not frequent to VOCABULARY and its cell."""

    def __init__(self, words: dict[str, int]):
        super().__init__()
        self.words = words

    def __missing__(self, word: str) -> int:
        known = self.words.get(word)
        made = self[word] = VOCABULARY + cell_of(word) if known is None else known
        return made


def number(texts: DataFrame, said: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids (numbers in 16 bits each), within (sum of the cells' log shares), split once."""
    kind = dict(texts.dtypes)["doc_id"]
    sent = texts.sparkSession.sparkContext.broadcast(said)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, shares = _Numbers(sent.value.words), sent.value.shares
        for batch in slices(batches, 1):
            ids, sizes, within = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                found = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
                cells = found[found >= VOCABULARY] - VOCABULARY
                within.append(float(shares[cells].sum(dtype=np.float64)))
                found[found >= VOCABULARY] = FREQUENT + cells // CELLS
                ids.append(found.astype("<u2").tobytes())
                sizes.append(len(words))
            if len(numbers) > KEPT_WORDS:
                numbers.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(within, pa.float64())],
                                             names=["doc_id", "n_tokens", "ids", "within"])
    return texts.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, within double")


def _tokens(batch: pa.RecordBatch, sizes: int, ids: int) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(batch.column(ids).to_pylist()), dtype="<u2")
    return flat, batch.column(sizes).to_numpy()


BLOCK = 1024


def fit_network(numbered: DataFrame, seed: int = 11) -> Network:
    """Train on every token of every text: each task passes over its own part from the same start, and the parameters are
    averaged over tasks, weighted by their tokens.

    Each task sends its parameters in blocks, so what is gathered grows with the number of tasks; blocks are averaged by
    Spark with partial sums, and one network reaches the driver. The result depends on how the texts are split into tasks,
    as any such averaging does. Without tokens the start is returned.
    """
    begin = Network.start(seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = begin.like(begin.flat())
        squares = [np.full(p.shape, 1e-6, dtype=np.float32) for p in net.parts()]
        total = 0
        for batch in slices(batches, 1):
            flat, sizes = _tokens(batch, 0, 1)
            if len(flat):
                train(net, flat, contexts(flat, sizes), squares)
                total += len(flat)
        if total:
            values = net.flat()
            values = np.pad(values, (0, -len(values) % BLOCK))
            offsets = pa.array(np.arange(0, len(values) + 1, BLOCK, dtype=np.int32))
            blocks = len(values) // BLOCK
            yield pa.RecordBatch.from_arrays([pa.array(range(blocks), pa.int32()), pa.array([float(total)] * blocks),
                                              pa.ListArray.from_arrays(offsets, pa.array(values))], names=["block", "tokens", "part"])
    sent = numbered.select("n_tokens", "ids").mapInArrow(run, "block int, tokens double, part array<float>")
    mean = sent.select("block", "tokens", array_to_vector("part").alias("part")).groupBy("block").agg(Summarizer.mean(F.col("part"), F.col("tokens")).alias("mean"))
    rows = mean.select("block", vector_to_array("mean", "float32").alias("mean")).orderBy("block").toArrow()
    return begin.like(rows.column("mean").combine_chunks().flatten().to_numpy()) if len(rows) else begin


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum of log P(word | both sides)), mean_log of every row.

    Vocabulary and network come from all documents; texts are split once more and then read as numbers. The FREQUENT most
    frequent words are tokens of their own; another word is the token of its bucket, predicted like any other and seen as
    context, times the share of its cell in the bucket by the counts of all documents. Words of the same cell are one word. A
    text without words has 0 tokens, a sum of 0 and a NULL mean; repeated rows and NULL ids are rows like any other.
    """
    df = documents(docs, id_col, text_col)
    numbered = materialise(number(df, vocabulary(df)), "numbers")
    sent = docs.sparkSession.sparkContext.broadcast(fit_network(numbered))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            flat, sizes = _tokens(batch, 1, 2)
            logs = log_probabilities(sent.value, flat, contexts(flat, sizes))
            total = np.zeros(len(sizes))
            full = np.flatnonzero(sizes)
            if len(full):
                total[full] = np.add.reduceat(logs, (np.cumsum(sizes) - sizes)[full])
            total += batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(total)], names=["doc_id", "n_tokens", "log_likelihood"])
    kind = dict(df.dtypes)["doc_id"]
    scored = numbered.mapInArrow(run, f"doc_id {kind}, n_tokens long, log_likelihood double")
    return scored.withColumn("mean_log", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
