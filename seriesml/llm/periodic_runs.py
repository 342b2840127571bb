"""Periodic runs of words: a suffix automaton whose link tree is accessed prefix by prefix gives, for every end, the latest
earlier occurrence of each suffix; where such an occurrence is near enough, the text repeats itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seriesml.llm.common import documents, slices

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run has LEAST words at least and TIMES times its period.
LEAST, TIMES = 6, 4


def automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, lengths of the longest word of each state, and the state of each prefix."""
    following, link, length, state = [{}], [-1], [0], []
    last = 0
    for c in word:
        new = len(link)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(link)
                following.append(following[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
        state.append(new)
    return link, length, state


class LinkTree:
    """The link tree cut into paths of one colour, each a splay tree by depth; the colour stands at the splay tree's root."""

    def __init__(self, link: list[int]):
        self.up = list(link)  # the parent in the splay tree; at its root, the tree parent of the path's top
        self.left, self.right, self.colour = [-1] * len(link), [-1] * len(link), [0] * len(link)

    def splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                steps = (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
            else:
                steps = (x,)
            for y in steps:
                p = up[y]
                g = up[p]
                if g >= 0 and left[g] == p:
                    left[g] = y
                elif g >= 0 and right[g] == p:
                    right[g] = y
                else:
                    colour[y] = colour[p]
                if left[p] == y:
                    b = left[p] = right[y]
                    right[y] = p
                else:
                    b = right[p] = left[y]
                    left[y] = p
                if b >= 0:
                    up[b] = p
                up[p], up[y] = y, g

    def access(self, v: int, colour: int) -> list[tuple[int, int]]:
        """Give the path from the root to `v` one colour. What it was cut of, from the deepest: (deepest state, colour)."""
        met, below, x = [], -1, v
        while x >= 0:
            self.splay(x)
            deeper = self.right[x]
            if deeper >= 0:
                self.colour[deeper] = self.colour[x]
            self.right[x] = below
            if self.colour[x]:
                met.append((x, self.colour[x]))
            below, x = x, self.up[x]
        self.splay(v)
        self.colour[v] = colour
        return met


def runs_within(word: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of `word`.

    At end i, a piece of the accessed path with colour i - d and a longest word of n letters says that the text from
    i - d - n to i has period d, and that no nearer occurrence of its later part, so no smaller period, exists. Runs reach as
    far left as n says; they are carried on to the right while the next end finds the same start and period.
    """
    link, length, state = automaton(word)
    tree, open_, runs = LinkTree(link), {}, []
    for i, v in enumerate(state, 1):
        for x, before in tree.access(v, i):
            d, n = i - before, length[x]
            if n >= (times - 1) * d and n + d >= least:
                start, at = i - d - n, open_.get(d)
                if at is not None and runs[at][0] == start:
                    runs[at] = (start, n + d, d)
                else:
                    open_[d] = len(runs)
                    runs.append((start, n + d, d))
    return runs


def stretches(codes: np.ndarray, owner: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Places (from, to) that may hold runs: all words of a run stand in it `times` times at least, so a word that is rarer in
    its text, or between two such words, is in no run and no run goes across it. What is left is cut until nothing changes.
    """
    _, inverse, counts = np.unique(owner * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True, return_counts=True)
    todo, found = _between(counts[inverse] < times, owner, 0, least), []
    while todo:
        a, b = todo.pop()
        part = codes[a:b]
        if b - a < 256:
            seen = Counter(part.tolist())
            rare = np.array([seen[c] < times for c in part.tolist()])
        else:
            _, inverse, counts = np.unique(part, return_inverse=True, return_counts=True)
            rare = counts[inverse] < times
        if rare.any():
            todo += _between(rare, None, a, least)
        else:
            found.append((a, b))
    return sorted(found)


def _between(rare: np.ndarray, owner: np.ndarray | None, at: int, least: int) -> list[tuple[int, int]]:
    """Maximal stretches of `least` places or more without a rare one and within one owner."""
    fine = np.flatnonzero(~rare)
    if len(fine) < least:
        return []
    breaks = fine[1:] != fine[:-1] + 1
    if owner is not None:
        breaks |= owner[fine[1:]] != owner[fine[:-1]]
    cut = np.flatnonzero(breaks) + 1
    starts, ends = fine[np.concatenate([[0], cut])], fine[np.concatenate([cut - 1, [len(fine) - 1]])] + 1
    long = ends - starts >= least
    return list(zip((starts[long] + at).tolist(), (ends[long] + at).tolist()))


def _repeats(rewrite: Callable | None, least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}
        for batch in slices(batches, 1):
            said = [_WORD.findall(t) for t in batch.column(1).to_pylist()]
            if rewrite is not None:
                said = [rewrite(i, words) for i, words in zip(batch.column(0).to_pylist(), said)]
            sizes = np.array([len(w) for w in said], dtype=np.int64)
            if len(numbers) > 200_000:
                numbers = {}
            codes = np.fromiter((numbers.setdefault(w, len(numbers)) for words in said for w in words), dtype=np.int64, count=int(sizes.sum()))
            owner, first = np.repeat(np.arange(len(said)), sizes), np.cumsum(sizes) - sizes
            runs: list[list[tuple[int, int, int]]] = [[] for _ in said]
            for a, b in stretches(codes, owner, least, times):
                i = int(owner[a])
                runs[i] += [(a - int(first[i]) + s, n, q) for s, n, q in runs_within(codes[a:b].tolist(), least, times)]
            left = []
            for words, found in zip(said, runs):
                found.sort(key=lambda r: (r[0], r[2]))
                if found:
                    gone = np.zeros(len(words), dtype=bool)
                    for s, n, q in found:
                        gone[s + q:s + n] = True
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                left.append(" ".join(words))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            made = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), made, pa.array(left, pa.string())],
                                             names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def repeated_runs(docs: DataFrame, rewrite: Callable | None = None, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed, for every row without a shuffle.

    A run is a stretch of words with a smallest period, of `least` words and `times` periods at least, that cannot be longer.
    `collapsed` is the text's words without those after the first period of any run, joined by one blank. `rewrite` takes an
    id and the words of its text and gives the words to look at. Whole texts are taken, about 4 MB at a time. NULL and empty
    texts have no words, no runs and an empty `collapsed`; repeated rows and NULL ids are rows like any other.
    """
    df = documents(docs, id_col, text_col)
    kind = dict(df.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return df.mapInArrow(_repeats(rewrite, least, times), schema)
