"""Spelling variants against all pairs of words and a plain count of the texts."""

import random
import re
import zlib
from collections import Counter

import pytest

from arquivo.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(words, times=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def counted(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vocabulary(rng, size, letters, lengths):
    words = set()
    while len(words) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))
        words.add(w)
        for _ in range(rng.randrange(4)):  # and words close to it
            i, how = rng.randrange(len(w)), rng.randrange(3)
            words.add(w[:i] + ("" if how == 0 else rng.choice(letters)) + w[i + (how < 2):])
    return {w: 5 * int(rng.paretovariate(0.4) % 10**6 + 1) for w in words}


@pytest.mark.parametrize("block,group", [(spelling.BLOCK_LETTERS, spelling.GROUP_LETTERS), (40, 3000)])
def test_equals_all_pairs(spark, block, group):
    rng = random.Random(block)
    words = vocabulary(rng, 200, "abcé", [2, 3, 5, 6, 7, 8]) | vocabulary(rng, 40, "abcdÿ", [30, 31])
    words |= {"x" * k: k for k in range(2, 40)} | {"hotstart" + c: 5 for c in "abcdefghijklmnop"}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.variants(df, block_letters=block, group_letters=group)) == plain(words)


def test_index_finds_one_edit_only():
    words = ["abcdef", "abcdeg", "abcdefg", "bcdef", "abdcef", "fedcba", "abcdef" * 20, "a"]
    a, b = spelling._pairs(words)
    assert {(words[i], words[j]) for i, j in zip(a, b)} == {(x, y) for x in words for y in words if one_edit(x, y)}


def test_whole_texts(spark):
    rng = random.Random(8)
    base = ["colour", "color", "Colours", "straße", "STRASSE", "naïveté", "naivete", "×÷×÷×÷", "short", "a"]
    rows = [(k, " ".join(rng.choice(base) for _ in range(300)) + "\n.colourscolourscolours" + "z" * 4000) for k in range(30)]
    rows += [(None, "nullid " * 200), (3, None), (4, ""), (5, "…—"), (5, "…—"), (6, rows[6][1])]
    df = spark.createDataFrame([(i, t, 1, "w", 2) for i, t in rows], "doc_id long, text string, n long, word string, key int")
    want = counted(rows)
    found = spelling.vocabulary(df, misspelt=199)
    assert {r.word: r.n for r in found.collect()} == want and len(want) > 8
    assert result(spelling.variants(found)) == plain(want)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(df)).collect() == []
