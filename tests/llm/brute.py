"""Brute-force versions of the operators, for small tables."""

import re
from collections import Counter

import numpy as np
import xxhash

MASK = 2**64 - 1


def components(n, pairs):
    """The index of every item's smallest companion."""
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def majority(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    return majority([xxhash.xxh64_intdigest(g, 42) for g in grams])


def near(fps, bits):
    fps = np.array(fps, np.uint64)
    return [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= bits) if j > i]


def simhash_components(ids, texts):
    fps = [fingerprint(t) for t in texts]
    root = components(len(ids), near(fps, 3))
    least = {}
    for i, r in zip(ids, root):
        least[r] = min(least.get(r, i), i)
    return fps, [least[r] for r in root]


def line_words(line):
    return [w for w in re.split(r"[\W_]+", line.lower()) if w]


def alike(a, b):
    v, w = a.split(" "), b.split(" ")
    return levenshtein(v, w) <= max(len(v), len(w)) // 5 or levenshtein(a, b) <= max(len(a), len(b)) // 10


def line_links(lines, short=8):
    """All pairs of lines that are alike by words, or of which one has fewer than ``short`` words
    and they are alike. Word counts bound edits from below, so most pairs need no distance."""
    words = [x.split(" ") for x in lines]
    n = np.array([len(w) for w in words])
    counts = np.array([np.bincount([xxhash.xxh64_intdigest(u.encode()) % 512 for u in w], minlength=512) for w in words], np.int16)
    pairs = []
    for i in range(len(lines)):
        most = np.maximum(n[i + 1:], n[i]) // 5
        may = np.abs(counts[i + 1:] - counts[i]).sum(1) <= 2 * most
        for j in np.flatnonzero(may) + i + 1:
            if levenshtein(words[i], words[j]) <= max(n[i], n[j]) // 5:
                pairs.append((i, int(j)))
        few = np.flatnonzero(~may & (np.minimum(n[i + 1:], n[i]) < short)) + i + 1
        for j in few:
            k = max(len(lines[i]), len(lines[j])) // 10
            if abs(len(lines[i]) - len(lines[j])) <= k and levenshtein(lines[i], lines[j]) <= k:
                pairs.append((i, int(j)))
    return pairs


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def line_groups(docs):
    """{(doc_id, line_no): first} of the lines that occur more than once. docs: {id: text}."""
    where = {}
    for d, text in sorted(docs.items()):
        for k, line in enumerate((text or "").split("\n")):
            if w := line_words(line):
                where.setdefault(" ".join(w), []).append((d, k))
    lines = sorted(where)
    pairs = line_links(lines)
    groups = {}
    for i, r in enumerate(components(len(lines), pairs)):
        groups.setdefault(r, []).extend(where[lines[i]])
    return {at: min(g) for g in groups.values() if len(g) > 1 for at in g}


def without_repeats(docs):
    first = line_groups(docs)
    return {d: t if t is None else "\n".join(
        x for k, x in enumerate(t.split("\n")) if first.get((d, k), (d, k)) == (d, k)) for d, t in docs.items()}


def shingles(text):
    w = line_words(text or "")
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def runs(text, k):
    w = line_words(text or "")
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}


def contaminated(docs, items):
    want = {i: shingles(t) for i, t in items.items()}
    short = {len(line_words(t or "")) for t in items.values()} & {1, 2, 3, 4}
    have = {d: set().union(*(runs(t, k) for k in {5} | short)) for d, t in docs.items()}
    return {(d, i, len(s & h), len(s)) for d, h in have.items() for i, s in want.items() if s and 5 * len(s & h) >= 4 * len(s)}


def quality_counts(text):
    raw = (text or "").encode()
    w = raw.split()
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in raw.split(b"\n") if x.split()]
    return (len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def base_failed(counts):
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
