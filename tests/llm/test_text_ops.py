"""SimHash, quality, decontamination and line dedup against brute force, and their edge cases."""

import random

import numpy as np
import pytest

from arquivo.llm import common, decontam, lines, quality, simhash
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASH = "id long, rid long, fp long, h long, key long, n long, gone string, first string, component long, bin long"


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = {}
    for i in range(60):
        out[i] = "\n".join(" ".join(words(rng, rng.randint(3, 60))) for _ in range(rng.randint(1, 4)))
    for i in range(60, 120):  # near copies: a word changed, words added, or none
        w = out[rng.randrange(60)].split(" ")
        w[rng.randrange(len(w))] = rng.choice(["w1", "new", "w2 w3"])
        out[i] = " ".join(w)
    for i in range(120, 130):
        out[i] = out[rng.randrange(120)]
    out |= {130: "", 131: " \t\n ", 132: "one", 133: "Two Words", 134: "two words", 135: " ".join(words(rng, 30_000)), 136: None}
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], SCHEMA).repartition(5)


def edge(spark, rows=True):
    """Null ids and texts, repeated rows, clashing columns; or no rows at all."""
    extra = (None,) * 9 + (1,)
    data = [(None, "a b c d e f g h i j k l", None, None, None), (1, "a b c d e f g h i j k l", "en", "s", 1),
            (1, "a b c d e f g h i j k l", "en", "s", 1), (2, None, "en", None, 0), (3, "", "en", "s", 0), (None, None, None, None, None)]
    return spark.createDataFrame([r + extra for r in data] if rows else [], f"{SCHEMA}, {CLASH}")


def test_simhash_equals_brute_force(docs, texts):
    rows = {r.doc_id: r for r in simhash.simhash_groups(docs).collect()}
    ids = sorted(texts)
    fps, least = brute.simhash_components(ids, [texts[i] for i in ids])
    assert [rows[i].fp & brute.MASK for i in ids] == fps
    assert [rows[i].component for i in ids] == least
    assert len(set(least)) < len(ids) - 15


def test_simhash_takes_crowded_nodes_apart(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(150)}
    fps |= {rng.getrandbits(64) for _ in range(50)} | {0, brute.MASK, 1 << 63, 7}
    fps = sorted(fps)
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = simhash.links(frame, node_rows=64).collect()
    at = {x: i for i, x in enumerate(signed)}
    assert brute.components(len(fps), [(at[r.a], at[r.b]) for r in found]) == brute.components(len(fps), brute.near(fps, 3))


def test_simhash_edges(spark):
    rows = simhash.simhash_groups(edge(spark)).collect()
    assert len(rows) == 6
    assert sorted((r.doc_id is None, r.doc_id, r.component) for r in rows if r.doc_id is not None) == [
        (False, 1, 1), (False, 1, 1), (False, 2, 2), (False, 3, 2)]
    assert sorted(r.component for r in rows if r.doc_id is None) == [1, 2]
    assert simhash.simhash_groups(edge(spark, False)).collect() == []


def test_components_of_a_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(i * 7919 % n, (i + 1) * 7919 % n) for i in range(n - 1)], "a long, b long")
    rows = common.components(edges).collect()
    assert {r.component for r in rows} == {0} and {r.node for r in rows} == set(range(1, n))


@pytest.mark.parametrize("crowd", [64, 3])
def test_line_groups_equal_brute_force(docs, texts, crowd):
    rows = lines.line_groups(docs, crowd=crowd).collect()
    got = {(r.id, r.line_no): (r["first"].id, r["first"].line_no) for r in rows}
    assert got == brute.line_groups(texts)
    assert any(brute.line_words(texts[a].split("\n")[i]) != brute.line_words(texts[b].split("\n")[j]) for (a, i), (b, j) in got.items())


def test_lines_are_taken_out(docs, texts):
    got = {r.doc_id: r.text for r in lines.stage_lines(docs.sparkSession, docs, "").collect()}
    assert got == brute.without_repeats(texts)


def test_scratch_deletes_what_it_owns(spark):
    import os

    with common.scratch() as outer:
        with common.scratch() as keep:
            left, result = common.settle(spark.range(3), "test"), keep(common.settle(spark.range(4), "test"))
        assert not os.path.exists(left.settled_path) and result.count() == 4
        final = outer(common.settle(result.where("id > 1"), "test"))
    assert not os.path.exists(result.settled_path) and final.count() == 2
    with pytest.raises(ZeroDivisionError), common.scratch():
        left = common.settle(spark.range(3), "test")
        raise ZeroDivisionError
    assert not os.path.exists(left.settled_path)


def test_line_edges(spark):
    out = lines.dedup_lines(edge(spark))
    assert out.columns == edge(spark).columns
    rows = [(r.doc_id, r.text) for r in out.collect()]
    same = "a b c d e f g h i j k l"
    # Null ids come first; equal rows are one document; null and empty texts stay.
    assert sorted(rows, key=str) == sorted([(None, same), (1, ""), (1, ""), (2, None), (3, ""), (None, None)], key=str)
    assert lines.dedup_lines(edge(spark, False)).collect() == []


def test_decontamination_equals_brute_force(spark, docs, texts):
    rng = random.Random(8)
    items = {}
    for i in range(25):
        w = brute.line_words(texts[rng.randrange(60)])
        items[i] = " ".join(w[:40])
    for i in range(25, 40):  # some words changed: more or less than a fifth of the shingles
        w = brute.line_words(texts[135])[i * 100 : i * 100 + 60]
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = "other"
        items[i] = " ".join(w).upper()
    items |= {40: "two, WORDS", 41: "one", 42: "", 43: None, 44: "never seen words of an item"}
    frame = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {tuple(r) for r in decontam.contaminated(docs, frame).select("id", "item", "n_shared", "n_shingles").collect()}
    assert got == brute.contaminated(texts, items)
    assert any(s < n for _, _, s, n in got) and any(i == 40 for _, i, _, _ in got)


def test_short_items_are_found_inside_documents(spark):
    docs = {1: "One two, ALPHA beta gamma delta three four five six", 2: "alpha beta gamma", 3: "delta alpha beta delta",
            4: "solo", 5: "a b c d solo", 6: "", 7: None, 8: "alphabeta gamma delta", 9: "alpha beta gamma delta"}
    items = {1: "alpha beta gamma delta", 2: "alpha-beta", 3: "solo", 4: "", 5: None, 6: "one two alpha beta gamma"}
    frame = [spark.createDataFrame(list(x.items()), f"{c} long, text string") for x, c in ((docs, "doc_id"), (items, "item_id"))]
    got = {tuple(r) for r in decontam.contaminated(*frame).select("id", "item", "n_shared", "n_shingles").collect()}
    assert got == brute.contaminated(docs, items)
    assert {(d, i) for d, i, *_ in got} == {(1, 1), (9, 1), (1, 2), (2, 2), (3, 2), (9, 2), (4, 3), (5, 3), (1, 6)}


def test_decontamination_edges(spark):
    items = spark.createDataFrame([(1, "a b c d e f"), (None, "f g h i j"), (1, "a b c d e f")], "item_id long, text string")
    rows = decontam.contaminated(edge(spark), items).select("id", "item").collect()
    assert {tuple(r) for r in rows} == {(None, 1), (None, None), (1, 1), (1, None)} and len(rows) == 4
    assert decontam.contaminated(edge(spark, False), items).collect() == []
    assert decontam.contaminated(edge(spark), items.limit(0)).collect() == []


def test_quality_counts_equal_brute_force(spark, docs, texts):
    more = {1000: "a b c d e a b c d e x a b c d e", 1001: "l1 x\nl1 x\n\n \nl1 x", 1002: "f\x0bf\x0cf off", 1003: "** a|b <c> é"}
    frame = docs.union(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in more.items()], SCHEMA))
    rows = quality.statistics(frame).collect()
    everything = texts | more
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality_counts(everything[r.id]), r.id


def test_quality_rules_are_learned(spark):
    rng = random.Random(2)
    data, labels = [], []
    for i in range(600):
        w = words(rng, 40, 5000)
        bad = i % 6 == 0
        if bad:
            w = [x + rng.choice(["***", "|"]) for x in w] if i % 12 else [x.upper() for x in w]
        data.append((i, " ".join(w), "en", "s", 0))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1))
    labels += [(1, None), (None, 0), (3, 0), (3, 1), (10**6, 0)]
    docs = spark.createDataFrame(data, SCHEMA)
    out, rules = quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r.id: r.kept for r in out.collect()}
    assert sum(got[i] == (i % 6 != 0) for i in got) >= 595
    assert rules.sql().startswith("CASE WHEN ") and len(rules.rules) >= 2


def test_quality_edges(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out, rules = quality.quality(edge(spark), labels)
    assert rules.rules == [] and len(out.collect()) == 6
    assert {(r.id, r.kept) for r in out.collect()} == {(None, True), (1, True), (2, False), (3, False), (None, False)}
    assert quality.quality(edge(spark, False), labels)[0].collect() == []


def test_trie_walk_on_random_sets():
    rng = np.random.default_rng(4)
    for n in (2, 50, 700):
        base = rng.integers(0, 2**63, 4, dtype=np.uint64)
        x = np.unique(base[rng.integers(0, 4, n)] ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
                      ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)))
        first = simhash._links(x, 0, 0, 3)
        turned = (x << np.uint64(32)) | (x >> np.uint64(32))
        order = np.argsort(turned)
        second = simhash._links(turned[order], 0, 0, 3)
        pairs = list(enumerate(first)) + [(order[i], order[j]) for i, j in enumerate(second)]
        assert brute.components(len(x), pairs) == brute.components(len(x), brute.near(x, 3))


def test_quality_rules_that_use_a_statistic_twice(spark, monkeypatch):
    """Rates of texts without words are null, also where the optimizer computes them for every row."""
    rules = quality.Rules([[("mean_word", ">", 5.0), ("mean_word", "<=", 9.0), ("upper_rate", "<=", 0.5)], [("dup_line_rate", ">", 0.5), ("dup_line_rate", "<=", 0.9)]])
    monkeypatch.setattr(quality, "learn", lambda labelled: rules)
    rows = [(0, ""), (1, None), (2, "abcdefg " * 12), (3, " ".join(f"ab{i}" for i in range(20))), (4, "\n\t ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    kept = {r.id: r.kept for r in quality.quality(docs, labels)[0].collect()}
    assert kept == {0: False, 1: False, 2: False, 3: True, 4: False}
    long = spark.createDataFrame([(2, " ".join(f"abcde{i}" for i in range(10, 30)))], "doc_id long, text string")
    assert [r.kept for r in quality.quality(docs.where("doc_id <> 2").union(long), labels)[0].where("id = 2").collect()] == [False]
