"""Removal of repeated word sequences against all windows of all texts."""

import random

import numpy as np
import pytest

from arquivo.llm import common, substrings


def plain(rows, k):
    """What is left of each row, by comparing every window with all; rows: (id, text)."""
    first, words = {}, {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        words[i, t] = w = (t or "").encode().split()
        for j in range(len(w) - k + 1):
            first.setdefault(tuple(w[j:j + k]), (i, t, j))
    out = []
    for i, t in rows:
        w, gone = words[i, t], set()
        for j in range(len(w) - k + 1):
            if first[tuple(w[j:j + k])] != (i, t, j):
                gone.update(range(j, j + k))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=str)


def result(spark, rows, k):
    df = spark.createDataFrame([(i, t, 1, 2, "x", 3) for i, t in rows],
                               "doc_id long, text string, rid long, at int, spans string, n int")
    out = substrings.without_repeats(df, k=k).collect()
    return sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in out), key=str)


def cases(rng):
    def text(n, kinds=4000):
        return [f"w{rng.randrange(kinds)}" for _ in range(n)]

    passages = [text(rng.choice((19, 20, 21, 50, 200))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = text(rng.randrange(40))
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += p[a:rng.randrange(a, len(p) + 1)] if rng.random() < 0.6 else p
            parts += text(rng.randrange(30))
        if rng.random() < 0.2:  # a near copy of an earlier document
            parts = rows[rng.randrange(len(rows))][1].split() if rows else parts
            if parts:
                parts[rng.randrange(len(parts))] = "changed"
        rows.append((i * 3, "\n ".join(parts)))
    rows += [(500 + i, " ".join(text(60, 2))) for i in range(6)]  # many branches
    rows += [(600, "a " * 300), (601, "a\t" * 25), (602, "a b " * 100), (603, "é é " * 40)]
    rows += [(700, None), (701, ""), (702, " \n\t"), (703, "one"), rows[4], rows[5], (None, rows[6][1]), (None, None)]
    return rows + [(1000 + i, " ".join(passages[0] + passages[-1])) for i in range(40)]


@pytest.mark.parametrize("k,requests", [(20, 10_000), (7, 3)])
def test_equals_all_windows(spark, k, requests, monkeypatch):
    monkeypatch.setattr(substrings, "REQUESTS", requests)
    rows = cases(random.Random(k))
    got = result(spark, rows, k)
    assert got == plain(rows, k)
    assert sum(r[2] > 0 for r in got) > 40


def test_spans_are_long_and_have_their_source(spark):
    rng = random.Random(2)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(i, "r%d", " ".join([f"{i}x{j}" for j in range(i)] + passage + [f"{i}y"])) for i in range(5)]
    df = spark.createDataFrame([(i, i * 10, t) for i, _, t in rows], "id long, rid long, text string")
    spans = sorted((r.id, r["at"], r.n, r.source.id, r.source["at"]) for r in substrings.repeated_spans(df).collect())
    assert spans == [(i, i, 381, 0, 0) for i in range(1, 5)]


def test_collisions_are_no_repeats(spark, monkeypatch):
    """Pieces whose hashes collide and whose texts differ are no repeats."""
    def cut(rows, k):
        return rows.selectExpr("id", "rid", "1L AS mini", "2L AS hash", "0 AS at", "1 AS n")

    monkeypatch.setattr(substrings, "_cut", cut)
    texts = ["a " * 20, "b " * 20, "a " * 20]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, rid long, text string")
    assert [(r.id, r.source.id) for r in substrings.repeated_spans(docs).collect()] == [(2, 0)]


def test_pieces_cover_every_window_once():
    rng = random.Random(1)
    words = [str(rng.randrange(50)).encode() for _ in range(500)]
    mini, hash, at, n = substrings.pieces(words)
    assert list(np.concatenate([np.arange(a, a + c) for a, c in zip(at, n)])) == list(range(481))
    other = substrings.pieces([b"x"] * 7 + words)
    assert set(zip(mini[1:-1], hash[1:-1])) <= set(zip(other[0], other[1]))
    assert all(len(x) == 0 for x in substrings.pieces(words[:19]))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.without_repeats(df).collect() == []


def test_freed_tables_are_gone(spark):
    import os

    df = common.settle(spark.range(3), "test")
    assert os.path.isdir(df.settled_path.removeprefix("file:"))
    common.free(df)
    assert not os.path.exists(df.settled_path.removeprefix("file:"))
