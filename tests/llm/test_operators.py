"""The methods themselves against plain versions, on planted data."""

import itertools
import math

import brute
import numpy as np
import pytest
from conftest import prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesml.llm import decontaminate, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, quality_rules, secret_scan, token_files, toxicity
from seriesml.llm.tokens import Encoder
from seriesml.session import scratch_path


@pytest.fixture(scope="module")
def both():
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    return Encoder(path), Tokenizer.from_file(path)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=['Cs']), st.sampled_from(list("abcXYZ019 .,'\n\t%éÉüßœḉ<|>")), ), max_size=40))
def test_word_by_word_equals_the_library(both, text):
    mine, library = both
    assert np.frombuffer(mine.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_files_read_by_range(spark, make, rng, tokenizer_path):
    docs = make([(i, prose(rng, 30)) for i in range(200)])
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs.repartition(7), path, tokenizer_path, 2)
    every = token_files.read_tokens(spark, path).orderBy("doc_id").collect()
    some = token_files.read_tokens(spark, path, first_id=50, last_id=59)
    assert some.orderBy("doc_id").collect() == every[50:60]
    assert "PushedFilters" in some._jdf.queryExecution().executedPlan().toString()
    assert sum(r["n_tokens"] for r in every[:50]) == every[50]["start"]


@pytest.mark.parametrize("limits", [packing.Limits(100), packing.Limits(100, documents=3), packing.Limits(100, attention=3000),
                                    packing.Limits(100, documents=4, attention=4000, rule="dot"), packing.Limits(100, weights=(1, 1, 1))])
def test_plan_respects_every_capacity(limits, rng):
    counts = {n: rng.randint(1, 40) for n in range(1, 51)}
    plan = packing.plan_packing(counts, limits)
    bins = {}
    for r in plan.itertuples(index=False):
        for rank in range(r.rank_from, r.rank_to):
            nth = rank - r.rank_from
            bins.setdefault(r.sequence + nth // r.each, []).append((r.offset + nth % r.each * r.length, r.length))
    assert sum(map(len, bins.values())) == sum(counts.values())
    for n, c in counts.items():
        ranks = sorted(itertools.chain(*[range(r.rank_from, r.rank_to) for r in plan.itertuples(index=False) if r.length == n]))
        assert ranks == list(range(c))
    cap = limits.capacity()
    assert brute.packed_fault([(s, o, n) for s, parts in bins.items() for o, n in parts], cap[0]) is None
    assert all(len(p) <= cap[1] and sum(n * n for _, n in p) <= cap[2] for p in bins.values())
    assert set(bins) == set(range(len(bins)))
    if limits.documents is None and limits.attention is None:
        assert len(bins) <= -(-sum(n * c for n, c in counts.items()) // cap[0]) + 1


def test_a_piece_that_fits_nowhere():
    with pytest.raises(ValueError):
        packing.plan_packing({20: 1}, packing.Limits(100, attention=300))


def test_sequences_hold_the_ids(spark, make, rng, tokenizer_path):
    docs = make([(i, prose(rng, rng.randint(1, 80))) for i in range(40)])
    pieces = packing.encode_pieces(docs, tokenizer_path, 0, 64)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    placed = packing.pack(narrow, packing.Limits(64))
    ids = {(r["doc_id"], r["piece"]): bytes(r["ids"]) for r in pieces.collect()}
    want = {}
    for r in sorted(placed.collect(), key=lambda r: r["offset"]):
        want[r["sequence_id"]] = want.get(r["sequence_id"], b"") + ids[r["doc_id"], r["piece"]]
    assert {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(pieces, placed).collect()} == want


def test_repeated_windows(spark, make, rng):
    words = ["a", "b", "ab", "c"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(150)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.measures(make(rows)).collect()}
    assert got == {i: brute.rule_measures(t)[4] for i, t in rows}


def test_bad_hosts_lose_their_documents(spark, make, rng):
    rows = [(i, prose(rng, 120), "good") for i in range(60)] + [(100 + i, "x " * 60 if i % 10 else prose(rng, 120), "bad") for i in range(40)]
    rows += [(200 + i, prose(rng, 120), f"h{i % 8}") for i in range(80)] + [(300, "few words", "single"), (301, prose(rng, 120), None)]
    got = {r["doc_id"]: r for r in quality_rules.judged(make(rows)).collect()}
    assert not got[100]["kept"] and got[100]["host_excess"] > 0 and not got[110]["kept"] and not got[110]["base_failed"]
    assert got[0]["kept"] and got[200]["kept"] and got[301]["kept"]
    assert got[300]["base_failed"] and got[300]["host_excess"] < got[100]["host_excess"] < 0.5  # one document says less than forty


def test_line_dedup_against_all_pairs(spark, make, rng):
    base = [[rng.choice("kalo mire tus veon shi dar pelquo zuka ren".split()) + rng.choice("abc") for _ in range(rng.randint(5, 14))] for _ in range(12)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(line))
                line[at:at + 1] = rng.choice([[], ["new"], [line[at], "new"], ["odd" + str(rng.randrange(5))]])
            lines.append("  ".join(line) if rng.random() < 0.2 else " ".join(line))
        rows.append((i, "\n".join(lines)))
    docs = make(rows)
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_lines(docs, line_dedup.repeated_lines(docs)).collect()}
    assert got == brute.line_dedup(rows, line_dedup.MIN_CHARS, line_dedup.MIN_WORDS)
    exact = {r["doc_id"]: r["text"] for r in line_dedup.without_lines(docs, line_dedup.repeated_lines(docs, edits=0)).collect()}
    assert exact == brute.line_dedup(rows, line_dedup.MIN_CHARS, 10 ** 6)


def test_decontamination_against_all_windows(spark, make, rng):
    words = "ka lo mi ren tus ve on shi É é 中".split()
    bench = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 7, 12, 13, 14, 20, 40])))) for i in range(25)]
    bench += [(40, bench[5][1]), (41, ""), (42, None)]
    rows = []
    for i in range(80):
        text = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            own = brute.item_words(rng.choice(bench)[1])
            a = rng.randint(0, max(0, len(own) - 10))
            at = rng.randint(0, len(text))
            text[at:at] = own[a:a + rng.randint(5, 30)]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(text).upper() if rng.random() < 0.2 else " ".join(text)))
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"]), r["contaminated"])
                 for r in decontaminate.contamination(make(rows), items).collect())
    assert got == brute.contaminated(rows, bench)
    assert sum(r[2] > 0 for r in got) > 20


def test_items_without_id_contaminate(spark, make, rng):
    passages = [prose(rng, 30), prose(rng, 5), prose(rng, 30)]
    rows = [(i, p) for i, p in enumerate(passages)] + [(3, prose(rng, 30))]
    bench = spark.createDataFrame([(None, passages[0]), (None, passages[1]), (7, passages[2]), (None, passages[2])], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"] == r["n_words"], r["n_items"], r["items"], r["contaminated"]) for r in decontaminate.contamination(make(rows), bench).collect()}
    assert got == {0: (True, 1, [], True), 1: (True, 1, [], True), 2: (True, 2, ["7"], True), 3: (False, 0, [], False)}


def test_large_sides_are_shuffled_with_the_same_result(spark, make, rng, monkeypatch):
    rows = [(i, prose(rng, 40, 4)) for i in range(12)]
    rows += [(20 + i, rows[i][1]) for i in range(6)]
    bench = spark.createDataFrame([(1, rows[3][1]), (2, rows[7][1])], "item_id long, text string")

    def answers():
        docs = make(rows)
        return ([sorted(map(str, decontaminate.contamination(docs, bench).collect())),
                 sorted((r["doc_id"], r["text"]) for r in line_dedup.without_lines(docs, line_dedup.repeated_lines(docs)).collect()),
                 sorted((r["doc_id"], r["class_id"]) for r in near_dedup.near_duplicates(docs).collect())])
    small = answers()
    monkeypatch.setattr("seriesml.llm.common.BROADCAST_ROWS", -1)
    assert answers() == small


def test_random_tokens_are_added(spark, make, rng):
    import string
    alphabet = string.ascii_letters + string.digits
    secrets = ["".join(rng.choice(alphabet) for _ in range(32)) for _ in range(60)]
    rows = [(i, f"{prose(rng, 12)} token = {s} {prose(rng, 5)} {'kalomiren' * 2}{'tusve' * rng.randint(1, 3)}") for i, s in enumerate(secrets[:40])]
    rows += [(100 + i, f"{prose(rng, 3)} {s} end") for i, s in enumerate(secrets[40:])] + [(200, "É\U0001f600 AKIA" + "A" * 16 + " password: x token: abcdefgh")]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secret_scan.secret_spans(make(rows)).collect()}
    text = dict(rows)
    want = {100 + i: [("markov", text[100 + i].index(s), text[100 + i].index(s) + 32)] for i, s in enumerate(secrets[40:])}
    assert sum(got[i] == w for i, w in want.items()) >= 18 and all(got[i] in (w, []) for i, w in want.items())
    assert all([k for k, _, _ in got[i]] == ["assign"] for i in range(40))
    assert ",".join(f"{k}:{a}:{b}" for k, a, b in got[200]) == brute.spans_of(text[200])


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(1)
    for shared in (0.3, 0.6, 0.9):
        elements = np.unique(rng.integers(1, 2 ** 63, 400, dtype=np.uint64))
        cut = int(len(elements) * (1 - shared) / 2)
        wa, wb = rng.integers(1, 4, len(elements)), rng.integers(1, 4, len(elements))
        a, b = (elements[cut:], wa[cut:]), (elements[:len(elements) - cut], wb[:len(elements) - cut])
        exact = near_dedup.probability_jaccard(a, b)
        naive = brute.weighted_similarity(*[__import__("collections").Counter(dict(zip(x[0].tolist(), x[1].tolist()))) for x in (a, b)])
        assert abs(exact - naive) < 1e-9
        seen = np.mean(np.equal(*near_dedup.signatures([a, b], 4000)))
        assert abs(seen - exact) < 4 * math.sqrt(exact * (1 - exact) / 4000)


def test_near_classes_against_all_pairs(spark, make, rng):
    rows, n = [], 0
    for _ in range(8):
        words = prose(rng, rng.choice([3, 30, 120, 300])).split()
        for _ in range(rng.choice([1, 2, 6, 25])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, len(words) // 60, len(words) // 15])):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(50))
            rows.append((n, " ".join(copy)))
            n += 1
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(make(rows).repartition(5)).collect()}
    assert got == brute.near_classes(rows)
    docs = make(rows)
    left = near_dedup.one_of_each(docs, near_dedup.near_duplicates(docs))
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(got.values()))


def test_copies_linked_through_one_original_only(spark, make, rng):
    words = [f"w{i}" for i in range(500)]
    rows = [(0, " ".join(words))]
    for i in range(1, 521):
        copy = list(words)
        for j in range(7):
            copy[rng.randrange(70 * j, 70 * j + 60)] = f"own{i}x{j}"
        rows.append((i, " ".join(copy)))
    counts = [brute.shingle_counts(t) for _, t in rows[:12]]
    assert min(brute.weighted_similarity(counts[0], c) for c in counts[1:]) > 0.8 > brute.weighted_similarity(counts[1], counts[2])
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(make(rows).repartition(5)).collect()}
    assert set(got.values()) == {0}


def test_a_band_of_classes_apart_is_compared_to_its_end(spark, make, rng, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    words, rows = [f"w{i}" for i in range(300)], []
    for i in range(14):  # every document is like the others to 0.7, and to 0.9 like the one after it or not at all
        copy = list(words)
        for j in range(6):
            copy[50 * j + 7 * (i // 2 % 7)] = f"own{i // 2}x{j}"
        if i % 2:
            copy[299] = f"last{i}"
        rows.append((i, " ".join(copy)))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(make(rows).repartition(3)).collect()}
    assert got == brute.near_classes(rows)


def test_texts_without_words_stand_alone(make):
    rows = [(i, t) for i, t in enumerate(["", "\n", "\n\n", "\n", "\t ", "\t ", "\u3000", "\xa0", None])] + [(9, "\tone word"), (10, "one\u3000word\n")]
    got = {r["doc_id"]: (r["class_id"], r["n_class"]) for r in near_dedup.near_duplicates(make(rows)).collect()}
    assert got == {i: (i, 1) for i in range(9)} | {9: (9, 2), 10: (9, 2)}


def test_a_long_chain_is_one_class(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    got = near_dedup.classes(links).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}


def test_neighbours_across_tasks(spark):
    members = spark.range(500).selectExpr("CAST(0 AS INT) AS band", "7L AS hash", "id * 7919 % 503 AS turn", "id AS key", "0L AS first").repartition(6)
    order = [r["key"] for r in members.orderBy("turn", "key").collect()]
    want = {tuple(sorted(p)) for p in zip(order, order[1:])}
    assert {(r["a"], r["b"]) for r in near_dedup.neighbours(members).collect()} == want


def test_machine_learns_what_only_pairs_tell():
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        docs.append(np.array([1] * int(a) + [2] * int(b) + list(rng.integers(10, 60, 5))))
        labels.append(int(a and b))
    model = toxicity.fit_machine(docs, labels)
    find = lambda *t: [toxicity._places(model.buckets, np.array(t))]
    score = {t: toxicity.probabilities(model.margins(find(*t)))[0] for t in ((1,), (2,), (1, 2), (10,))}
    assert score[1, 2] > 0.5 > max(score[1,], score[2,], score[10,])
    naive = model.bias + model.weights[find(1, 2)[0]].sum() + model.factors[find(1)[0][0]] @ model.factors[find(2)[0][0]]
    assert abs(naive - model.margins(find(1, 2))[0]) < 1e-9
    same = toxicity.fit_machine([np.array([1])] * 3, [0, 0, 0])
    assert same.bias < 0 and not len(same.buckets)


def test_labels_of_the_held_out_fold_are_not_read(spark, make):
    import zlib
    rows = [(i, "insult here" if i % 2 else "kind words") for i in range(80)]
    labels = [(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(80)]
    docs = make(rows)
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = docs.select("doc_id", toxicity.toxicity_score(docs["text"], model).alias("s")).collect()
    assert all((r["s"] >= 0.5) == r["doc_id"] % 2 for r in got)


def test_accuracies_without_labels():
    rng = np.random.default_rng(5)
    truth = rng.random(6000) < 0.8
    right = [0.95, 0.9, 0.85, 0.7]
    votes = np.stack([np.where(rng.random(6000) < 0.2, 0, np.where(rng.random(6000) < a, 2 * truth - 1, 1 - 2 * truth)) for a in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_classifier.fit_labels(patterns, counts)
    assert abs(model.prior - 0.8) < 0.03
    for j, a in enumerate(right):
        assert abs(model.tables[j, 1, 2] - a) < 0.05 and abs(model.tables[j, 0, 0] - a) < 0.08
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.95


def _slow_log(net, ids):
    out = []
    for t, word in enumerate(ids):
        near = [ids[t + k] if 0 <= t + k < len(ids) else lm_scoring.OUTSIDE for k in (-2, -1, 1, 2)]
        h = np.append(np.tanh(sum(net.embeddings[k][w] for k, w in enumerate(near)) + net.bias), 1)
        side, digits = lm_scoring.SIDE, [word // lm_scoring.SIDE ** 2, word // lm_scoring.SIDE % lm_scoring.SIDE, word % lm_scoring.SIDE]
        total = 0.0
        for d, digit in enumerate(digits):
            x = h @ net.outputs[:, d * side:(d + 1) * side] + sum(net.given[e][digits[e], d * side:(d + 1) * side] for e in range(d))
            total += x[digit] - np.log(np.exp(x).sum())
        out.append(total)
    return np.array(out)


def test_pseudo_likelihood_against_loops_and_training():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, lm_scoring.VOCABULARY, n) for n in (1, 2, 9, 0, 30)]
    ids, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
    net = lm_scoring.Network.start()
    want = np.concatenate([_slow_log(net, d.tolist()) for d in docs])
    assert np.allclose(lm_scoring.log_probabilities(net, ids, lm_scoring.contexts(ids, sizes)), want, atol=1e-4)
    pattern = np.tile([5, 90, 300, 700], 20_000)
    around = lm_scoring.contexts(pattern, np.array([len(pattern)]))
    squares = [np.full(p.shape, 1e-6, dtype=np.float32) for p in net.parts()]
    before = lm_scoring.log_probabilities(net, pattern, around).mean()
    for _ in range(5):
        lm_scoring.train(net, pattern, around, squares)
    after = lm_scoring.log_probabilities(net, pattern, around).mean()
    assert after > before + 3
    mixed = rng.permutation(pattern)
    assert lm_scoring.log_probabilities(net, mixed, lm_scoring.contexts(mixed, np.array([len(mixed)]))).mean() < after - 1


def test_rare_words_are_shared_out_by_their_counts(make):
    """Words of one bucket differ in texts of one word by their counts alone."""
    common = " ".join(f"c{i}" for i in range(lm_scoring.FREQUENT))
    buckets = {}
    for i in range(60_000):
        buckets.setdefault(lm_scoring.cell_of(f"seldom{i}") // lm_scoring.CELLS, {}).setdefault(lm_scoring.cell_of(f"seldom{i}"), f"seldom{i}")
    a, b, c = list(next(w for w in buckets.values() if len(w) >= 3).values())[:3]
    rows = [(i, t) for i, t in enumerate([a] * 4 + [b, c, "", " ".join([common] * 6)])]
    got = {r["doc_id"]: r for r in lm_scoring.pseudo_likelihood(make(rows)).collect()}
    assert abs(got[0]["log_likelihood"] - got[4]["log_likelihood"] - math.log(4)) < 1e-5 and abs(got[4]["log_likelihood"] - got[5]["log_likelihood"]) < 1e-5
    assert (got[6]["n_tokens"], got[6]["log_likelihood"], got[6]["mean_log"]) == (0, 0.0, None)


def test_every_score_word_by_word(spark, make, odd_rows):
    """The query's numbers from its vocabulary and network, one word at a time."""
    df = make(odd_rows[:9] + odd_rows[11:]).select("doc_id", "text")
    from seriesml.llm.common import documents
    texts = documents(df)
    said = lm_scoring.vocabulary(texts)
    net = lm_scoring.fit_network(lm_scoring.number(texts, said).coalesce(1))
    rows = lm_scoring.number(texts, said).collect()
    for r in rows:
        text = next(t for i, t in odd_rows if i == r["doc_id"]) or ""
        ids, within = [], 0.0
        for w in text.lower().split() if r["doc_id"] is not None else []:
            cell = lm_scoring.cell_of(w)
            ids.append(said.words.get(w, lm_scoring.FREQUENT + cell // lm_scoring.CELLS))
            within += 0 if w in said.words else said.shares[cell]
        if r["doc_id"] is not None:
            flat = np.frombuffer(r["ids"], "<u2")
            assert flat.tolist() == ids and abs(within - r["within"]) < 1e-6
            got = lm_scoring.log_probabilities(net, flat, lm_scoring.contexts(flat, np.array([len(flat)])))
            assert np.allclose(got, _slow_log(net, ids), atol=1e-3)


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, lm_scoring.VOCABULARY, 50)
    around = lm_scoring.contexts(ids, np.array([50]))
    net = lm_scoring.Network(*[p.astype(np.float64) for p in lm_scoring.Network.start().parts()])
    seen = [np.zeros(p.shape) for p in net.parts()]
    moved = lm_scoring.Network(*[p.copy() for p in net.parts()])
    lm_scoring.train(moved, ids, around, seen, rate=0.0)
    for part, squared in zip(net.parts(), seen):
        at = np.unravel_index(np.argmax(squared), squared.shape)
        kept, step = part[at], 1e-4
        part[at] = kept + step
        up = lm_scoring.log_probabilities(net, ids, around).mean()
        part[at] = kept - step
        down = lm_scoring.log_probabilities(net, ids, around).mean()
        part[at] = kept
        assert abs(abs((up - down) / (2 * step)) - math.sqrt(squared[at])) < 1e-3
