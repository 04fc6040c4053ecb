"""Token attribution, toxicity scores and packing against plain versions, and edge tables
through every stage of the pipeline."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from arquivo.llm import encode, packing, tokens, toxicity
from tests.llm.test_text_ops import edge

SF = "/root/testdata/sf0.001"
SAME = "a b c d e f g h i j k l"  # the text of edge's rows that have one


def plain_sections(values, by, rule, offsets):
    """Characters, tokens and crossing tokens of every section, character by character."""
    parts = [p for v in values for p in (v.split("\n") if by == "line" else [v])]
    owner = [k for k, p in enumerate(parts) for _ in range(len(p) + (k < len(parts) - 1))]
    out = [[owner.count(k), 0, 0] for k in range(len(parts))]
    for a, b in offsets:
        own = owner[a:b]
        place = {"start": own[0], "end": own[-1], "most": min(own, key=lambda k: (-own.count(k), k))}[rule]
        out[place][1] += 1
        out[place][2] += len(set(own)) > 1
    return [tuple(x) for x in out]


@pytest.mark.parametrize("rule", tokens.RULES)
def test_every_section_equals_a_plain_count(spark, rule):
    tokenizer, rng = Tokenizer.from_file(encode.default_path()), random.Random(2)
    pieces = ["\n", "\n\n", " \n ", "word", " word", "  ", "1999", "é", "中🙂", "\t", "."]
    data = [(i, rng.choice(["web", "", None]), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string")
    crossings = 0
    for by in ("line", "field"):
        got = {}
        for r in tokens.count_tokens(docs, fields=("source", "text"), rule=rule, by=by).collect():
            got.setdefault(r.doc_id, []).append((r.field, r.section, (r.n_chars, r.n_tokens, r.n_crossing)))
        for i, source, text in data:
            values = (source or "", text)
            offsets = tokenizer.encode("\n".join(values), add_special_tokens=False).offsets
            rows = sorted(got[i], key=lambda x: (x[0] == "text", x[1]))
            assert [x[2] for x in rows] == plain_sections(values, by, rule, offsets), (i, by)
            crossings += sum(x[2][2] for x in rows)
    assert crossings > 50


def test_toxicity_scores_equal_plain_loops():
    model, rng = toxicity.Cnn(3, size=64, dims=4, filters=3), random.Random(1)
    model.bias += 0.05
    model.scale, model.shift = 1.7, -0.4

    def vector(word):
        full = f"^{word}$".encode()
        grams = [full[i : i + n] for n in (4, 5) for i in range(len(full) - n + 1)]
        own = model.table[zlib.crc32(b"w " + full) % 64].astype(float)
        return own + sum(model.table[zlib.crc32(g) % 64].astype(float) for g in grams) / max(1, len(grams))

    def plain(words):
        x, z = [vector(w) for w in words], float(model.base)
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(3):
                values = [sum(float(x[a + j] @ model.conv[k][j, :, f]) for j in range(width)) + float(model.bias[k, f])
                          for a in range(len(x) - width + 1)]
                z += max([0.0, *values]) * float(model.out[k, f])
        return 1 / (1 + np.exp(-(model.scale * z + model.shift)))

    for n in (0, 1, 2, 3, 50, toxicity.CHUNK + 5):
        words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(n)]
        assert model.score(model.logit(words)) == pytest.approx(plain(words), abs=1e-5)


def plain_best_fit(sizes, capacity):
    """The number of bins if every item, longest first, goes where least room is left."""
    room = []
    for size in sorted(sizes, reverse=True):
        fits = [(gap, k) for k, gap in enumerate(room) if gap >= size]
        if fits:
            room[min(fits)[1]] -= size
        else:
            room.append(capacity - size)
    return len(room)


def test_best_fit_uses_as_many_bins_as_a_plain_one():
    rng = np.random.default_rng(5)
    for capacity, n in ((10, 50), (100, 400), (2048, 400)):
        for low in (1, capacity // 4):
            sizes = rng.integers(low, capacity + 1, n)
            assert len(packing.best_fit(sizes, capacity)[2]) == plain_best_fit(sizes.tolist(), capacity)


def test_partitions_need_few_more_sequences_than_one_best_fit(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, "a " * rng.randint(1, 2500)) for i in range(400)], "doc_id long, text string").repartition(30)
    rows = packing.pack(docs).collect()
    best = plain_best_fit([r.length for r in rows], 2048)
    assert -(-sum(r.length for r in rows) // 2048) <= len({r.sequence_id for r in rows}) <= 1.05 * best + 1


#: By stage: the (doc_id, text) of edge's rows that stay.
STAY = {
    "quality_rules": [(None, SAME), (1, SAME), (1, SAME)],  # the others have too few words
    "line_dedup": [(None, SAME), (1, ""), (1, ""), (2, None), (3, ""), (None, None)],  # null ids come first
    "simhash_near_dedup": [(1, SAME), (1, SAME), (2, None)],  # a null id names no group; no text is one text
    "benchmark_decontamination": [(None, SAME), (1, SAME), (1, SAME), (2, None), (3, ""), (None, None)],
}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_edge_tables(spark, name, stage):
    """Nulls in every column, repeated rows, empty texts, clashing columns; and no rows."""
    for rows in (True, False):
        docs = edge(spark, rows)
        out = stage(spark, docs, SF)
        if name == "best_fit_packing":
            assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in docs.collect())
            continue
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == (sorted(STAY[name], key=str) if rows else [])
