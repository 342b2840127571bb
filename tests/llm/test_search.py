"""Language, periodic runs and ranked search against plain versions."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesml.llm import language, lexical_search, periodic_runs
from seriesml.llm.catalogue import QUERIES
from seriesml.llm.queries_search import periodic


@pytest.fixture(scope="module")
def pieces():
    return language.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


# ---- runs

def runs_by_hand(words, least=6, times=4):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)  # the smallest period of a stretch comes first
            i = max(j, i + 1)
    inside = lambda r, o: o[0][0] <= r[0][0] and sum(o[0]) >= sum(r[0]) and o[1] < r[1]
    every = list(found.items())
    return sorted((s, n, q) for (s, n), q in every if not any(inside(((s, n), q), o) for o in every))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(0, 8))
def test_runs_of_small_alphabets(before, period, times):
    word = before + period * times + before[:7]
    assert sorted(periodic_runs.runs_within(word)) == runs_by_hand(word)
    codes = np.array(word, dtype=np.int64)
    got = [(a + s, n, q) for a, b in periodic_runs.stretches(codes, np.zeros(len(word), dtype=np.int64), 6, 4)
           for s, n, q in periodic_runs.runs_within(word[a:b])]
    assert sorted(got) == runs_by_hand(word)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=80))
def test_segments_name_the_latest_earlier_end(word):
    link, length, state = periodic_runs.automaton(word)
    tree = periodic_runs.LinkTree(link)
    for i, v in enumerate(state, 1):
        got = dict((c, length[x]) for x, c in tree.access(v, i))
        want = {}
        for n in range(1, i):
            ends = [e for e in range(n, i) if word[e - n:e] == word[i - n:i]]
            if ends:
                want[max(ends)] = n
        got = {c: n for c, n in got.items() if n}
        assert got == want


def test_long_texts_are_cut_only_where_no_run_is():
    rng = random.Random(5)
    words = [rng.randrange(400) for _ in range(6000)]
    for at in (100, 2000, 4000):
        p = rng.randint(1, 60)
        words[at:at + 9 * p] = words[at:at + p] * 9
    codes = np.array(words, dtype=np.int64)
    got = [(a + s, n, q) for a, b in periodic_runs.stretches(codes, np.zeros(len(words), dtype=np.int64), 6, 4)
           for s, n, q in periodic_runs.runs_within(words[a:b])]
    assert len(got) >= 3 and sorted(got) == runs_by_hand(words)


def test_runs_of_odd_rows(spark, make, odd_rows):
    got = periodic_runs.repeated_runs(make(odd_rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in odd_rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_words"] == 0 and by[1]["runs"] == [] and by[1]["collapsed"] == "" and by[3]["n_words"] == 0
    assert [tuple(x) for x in by[10]["runs"]] == [(0, 400, 8)] and by[10]["collapsed"] == "the very same line of many words again"
    assert periodic_runs.repeated_runs(make([])).collect() == []
    assert periodic(None, ["a"] * 9) == ["a"] * 9 and periodic(3, []) == []


def test_one_period_over_a_long_text(spark, make):
    words = ["w%d" % (i % 7) for i in range(200_000)]
    r = periodic_runs.repeated_runs(make([(1, " ".join(words))])).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 200_000, 7)] and r["collapsed"] == " ".join(words[:7])


# ---- search

def ranking_by_hand(docs, items, k=10):
    counts = [(i, Counter(lexical_search.terms_of(t or ""))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(lexical_search.terms_of(text or "")), []
        for i, c, n in counts:
            m = 25 + 75 * n * n_docs // total
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in asked.items() if c[t])
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scored)[:k])]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 14), st.integers(1, 9), max_size=15), max_size=6), st.integers(1, 5), st.integers(1, 12))
def test_intervals_settle_at_the_true_best(lists, k, least):
    size, score = 15, np.zeros(15, dtype=int)
    made = []
    for entries in lists:
        for d, x in entries.items():
            score[d] += x
        order = sorted(entries, key=lambda d: -entries[d])
        made.append((np.array(order, dtype=np.int64), -np.array([entries[d] for d in order], dtype=np.int64)))
    want = sorted((-s, d) for d, s in enumerate(score.tolist()) if s >= least)[:k]
    at, got = lexical_search.settle(made, size, k, least)
    assert [(-s, d) for d, s in zip(at.tolist(), got.tolist())] == want


def test_lists_are_not_read_to_their_end():
    places = np.arange(8192)
    rare, common = (np.array([5, 9]), np.array([-9_000_000, -8_000_000])), (places, -np.arange(8192, 0, -1, dtype=np.int64) - 10)
    at, score = lexical_search.settle([rare, common], 8192, 1)
    assert at.tolist() == [5] and score.tolist() == [9_000_000 + 8192 - 5 + 10]


@pytest.mark.parametrize("shard", [3, 8192])
def test_ranking_of_odd_rows(spark, make, odd_rows, shard):
    ties = [(100 + i, "same words here") for i in range(30)] + [(None, "same words here")]
    items = [(1, "same words word WORD"), (1, "again line line"), (None, "中文 école"), (2, None), (3, "nothing_of_this"), (4, " ".join(odd_rows[9][1].split()[:500]))]
    docs = odd_rows + ties
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS rank", "7 AS row", "0 AS doc_id")
    got = [tuple(r) for r in lexical_search.ranked(make(docs), table, shard=shard).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(ranking_by_hand(docs, items), key=key)
    assert lexical_search.ranked(make([]), table).collect() == [] and lexical_search.ranked(make(docs), table.limit(0)).collect() == []


def test_blocks_of_items(spark, make, odd_rows, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 2)
    items = [(i, w) for i, w in enumerate(["word", "line many", "same", "again", "the very"])]
    got = [tuple(r) for r in lexical_search.ranked(make(odd_rows), spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted(ranking_by_hand(odd_rows, items), key=str)


# ---- language

def test_all_segmentations_are_summed():
    names = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba", "<0xC3>", "<0xA9>"]
    p = {n: (i + 1) / 100 for i, n in enumerate(names)}
    table = np.log(np.array([[p[n], p[n] / 2] for n in names]))

    def by_hand(word, scale):
        total = [0.0] * (len(word) + 1)
        total[0] = 1.0
        for j in range(1, len(word) + 1):
            for i in range(j):
                part = word[i:j]
                if part in p:
                    total[j] += total[i] * p[part] * scale
                elif j == i + 1:
                    total[j] += total[i] * math.prod(p.get(f"<0x{b:02X}>", min(p.values())) * scale for b in part.encode())
        return math.log(total[-1])
    words = ["a", "ab", "aba", "abaab", "é", "aéb", "babab"]
    net = language.Pieces(names).lattice(words)
    got = net.log_likelihood(table)
    assert np.allclose(got, [[by_hand("▁" + w, 1), by_hand("▁" + w, 0.5)] for w in words])
    log_p = language._rows(table, net.piece)
    assert np.allclose(net.backward(log_p)[net.first], got)


def test_expected_counts_are_posterior_shares():
    names = ["▁a", "▁", "a"]
    table = np.log(np.array([[0.2], [0.5], [0.3]]))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["a"]), pa.array([0], pa.int32()), pa.array([7])], names=["word", "language", "n"])
    got = next(language._expected(names, table, 1)(iter([batch])))
    share = 0.2 / (0.2 + 0.15)
    assert dict(zip(got.column(0).to_pylist(), np.round(got.column(1).to_pylist(), 9))) == {0: round(7 * share, 9), 1: round(7 * (1 - share), 9), 2: round(7 * (1 - share), 9)}


def test_language_of_odd_rows(spark, make, odd_rows, pieces):
    docs = make(odd_rows)
    model = language.fit_languages(docs, pieces, rounds=1)
    assert model.names == ["en"]
    got = language.languages_of(docs, model, pieces).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in odd_rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[4] == by[9] == ("en", 1.0)
    empty = language.fit_languages(make([]), pieces)
    assert empty.names == [] and {r["lang_pred"] for r in language.languages_of(docs, empty, pieces).collect()} == {"und"}
    assert language.languages_of(make([]), model, pieces).collect() == []


def test_labels_of_the_held_out_fold_are_not_read(spark, data, pieces):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    other = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    a, b = (language.fit_languages(d, pieces, rounds=1) for d in (docs, other))
    assert a.names == b.names and np.array_equal(a.log_p, b.log_p)


def test_language_query(spark, data, pieces):
    """Held-out accuracy, and every row against the sum over segmentations word by word."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language.fit_languages(docs, pieces)
    finder = language.Pieces(pieces)
    truth = {i: (t, g) for i, t, g in duckdb.sql(f"SELECT doc_id, text, lang FROM '{data}/documents.parquet'").fetchall()}
    rows = QUERIES["op11_language_id"](spark, data).collect()
    assert len(rows) == len(truth)
    right, held, known = 0, 0, {}

    def likelihood(word):
        if word not in known:
            total = np.full((len(word) + 2, len(model.names)), -np.inf)
            total[0] = 0
            said = "▁" + word
            for j in range(1, len(said) + 1):
                for i in range(j):
                    k = finder.number.get(said[i:j])
                    steps = [k] if k is not None else [finder.bytes[b] for b in said[i:j].encode()] if j == i + 1 else None
                    if steps is not None:
                        total[j] = np.logaddexp(total[j], total[i] + sum(model.log_p[x] for x in steps))
            known[word] = total[len(said)]
        return known[word]
    for r in rows:
        text, lang = truth[r["doc_id"]]
        words = language.words_of(text or "")
        if words:
            sums = sum(likelihood(w) for w in words)
            assert r["lang_pred"] == model.names[int(sums.argmax())]
            assert abs(r["score"] - language.posteriors(model, sums[None])[0].max()) < 1e-6
        else:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["held_out"] and lang and words:
            held, right = held + 1, right + (r["lang_pred"] == lang)
    assert held > 20 and right >= 0.97 * held
