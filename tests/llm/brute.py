"""Plain Python versions of the contracts, for small inputs."""

from __future__ import annotations

import collections
import itertools
import re
import zlib

import numpy as np

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def blank_words(text):
    return [w for w in BLANKS.split(text or "") if w]


def token_rows(rows, tokenizer, end_id):
    """(doc_id, start, n_tokens, crc32) in id order."""
    out, at = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], dtype="<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def piece_rows(rows, tokenizer, end_id, size):
    out = []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], dtype="<u4")
        for n, at in enumerate(range(0, len(ids), size)):
            part = ids[at:at + size]
            out.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    return out


def packed_fault(rows, size):
    """What is wrong with (sequence_id, offset, length) rows; None when each sequence is gapless and within `size`."""
    by = collections.defaultdict(list)
    for s, o, n in rows:
        by[s].append((o, n))
    for s, parts in by.items():
        at = 0
        for o, n in sorted(parts):
            if o != at:
                return f"gap in {s}: {parts}"
            at += n
        if at > size:
            return f"{s} has {at}"
    return None


def rule_measures(text):
    words = blank_words(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = collections.defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i:i + 3])].append(i)
    hit = {p for at in grams.values() if len(at) > 1 for i in at for p in range(i, i + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def _edits(a, b):
    """Edit distance of two word lists."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_dedup(rows, min_chars, min_words):
    """doc_id to its text without repeated lines; ids are unique."""
    first, occurrences = {}, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        for pos, line in enumerate((text or "").split("\n")):
            if len(line) >= min_chars:
                said = tuple(blank_words(line))
                occurrences.append((i, pos, said))
                first.setdefault(said, (i, pos))
    distinct = sorted(first, key=first.get)
    near = {b for a, b in itertools.combinations(distinct, 2)
            if min(len(a), len(b)) >= min_words and abs(len(a) - len(b)) <= 1 and _edits(a, b) <= 1}
    gone = {(i, pos) for i, pos, said in occurrences if said in near or (i, pos) != first[said]}
    return {i: "\n".join(x for p, x in enumerate((text or "").split("\n")) if (i, p) not in gone) for i, text in rows}


def spans_of(text):
    kinds = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6, 2),
             ("access", re.compile(r"AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile(r"[0-9a-f]+"), 24, 0))
    found = [(m.start(), rank, kind, m.end()) for rank, (kind, p, least, g) in enumerate(kinds) for m in p.finditer(text or "") if len(m[g]) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def item_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(docs, items, window=13):
    """doc_id, n_words, n_hit, n_items, items, verdict."""
    wanted = collections.defaultdict(set)
    for item, text in items:
        words = item_words(text)
        k = min(window, len(words))
        for i in range(len(words) - k + 1) if k and item is not None else ():
            wanted[tuple(words[i:i + k])].add(str(item))
    sizes = {len(w) for w in wanted}
    out = []
    for i, text in docs:
        words, hit, got = item_words(text), set(), set()
        for k in sizes:
            for a in range(len(words) - k + 1):
                found = wanted.get(tuple(words[a:a + k]))
                if found:
                    hit.update(range(a, a + k))
                    got |= found
        out.append((i, len(words), len(hit), len(got), ",".join(sorted(got)), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def shingle_counts(text, size=5):
    words = (text or "").lower().split()
    return collections.Counter(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else None


def weighted_similarity(a, b):
    """Probability Jaccard from its definition."""
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in keys if a[i] and b[i])


def near_classes(rows, similarity=0.8):
    """doc_id to the smallest id of its class; ids are unique."""
    counts = {i: shingle_counts(t) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(counts), 2):
        x, y = counts[a], counts[b]
        if x and y and set(x) & set(y) and weighted_similarity(x, y) >= similarity:
            ra, rb = sorted((find(a), find(b)))
            root[rb] = ra
    return {i: find(i) for i in counts}
