"""Chat, tokens, packing, toxicity, language ID and WARC: exact round trips, held-out
accuracy, and edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arquivo.llm import chat, encode, langid, packing, tokens, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "id long, piece int, bin long, part long, ids string, head int, conv long, payload string, score double"
ODD = [" ", "  ", "\n", " \n", "a", "b'", "'s", "é", "ß", "1", "٣", ".", "!!", "\t", "\x1c", "the", " the", "中", "🙂",
       "<|endoftext|>", "ǅ", "\r", "ʼ", "¹", "​", " "]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(encode.default_path())


def odd_texts(n=2000):
    rng = random.Random(1)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(n)] + ["x" * 5000, " " * 3000]


@pytest.mark.parametrize("literal", [False, True])
def test_encoding_equals_the_tokenizer(literal):
    e, reference = encode.encoder(), Tokenizer.from_file(encode.default_path())
    reference.encode_special_tokens = literal
    for t in odd_texts() + ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "a" + " " * 60_000 + "b", "x\n" + "\n \t" * 30_000 + "<|endoftext|>"]:
        ids = e.encode(t, literal)
        assert ids.tolist() == reference.encode(t, add_special_tokens=False).ids
        assert e.decode(ids) == t
        if not literal:
            starts, ends = e.offsets(t)
            own = reference.encode(t, add_special_tokens=False).offsets
            assert [t[a:b].lstrip() for a, b in zip(starts, ends)] == [t[a:b].lstrip() for a, b in own]
    assert 50256 in e.encode("a <|endoftext|> b") and 50256 not in e.encode("a <|endoftext|> b", literal=True)


def test_a_million_blanks():
    e = encode.encoder()
    text = "a" + " " * 1_000_000 + "\n" * 200_000 + "b"
    assert e.decode(e.encode(text)) == text


def docs_frame(spark, rows=True):
    rng = random.Random(3)
    data = [(i, " ".join(f"word{rng.randrange(999)}" for _ in range(rng.choice([0, 1, 30, 200, 600, 1500])))) for i in range(120)]
    data += [(1000 + i, t) for i, t in enumerate(odd_texts(60))] + [(500, None), (501, ""), (502, "again"), (502, "again"), (None, "no id"),
                                                                  (503, "x y " * 9000)]
    extra = ("en", "s", 1) + (None,) * 9
    return spark.createDataFrame([r + extra for r in data] if rows else [], f"{SCHEMA}, {CLASH}").repartition(20)


def test_packing_round_trip(spark, reference):
    docs = docs_frame(spark)
    rows = packing.pack(docs, keep_ids=True).collect()
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault(r.doc_id, []).append(r)
    for of in sequences.values():
        at = 0
        for r in sorted(of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(pieces) == set(texts)
    for key, text in texts.items():
        ids = reference.encode(text or "", add_special_tokens=False).ids + [0]
        of = sorted(pieces[key], key=lambda r: r.piece)
        if key == 502:
            assert len(of) == 2 and of[0].length == of[1].length
            of = of[:1]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in of]).tolist() == ids
        assert all(r.start == sum(x.length for x in of[:k]) and r.piece == k for k, r in enumerate(of))
        assert all(r.length == 2048 for r in of[1:]) and all(r.ids_crc32 == zlib.crc32(r.ids) for r in of)
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.25 * total / 2048  # twenty partitions of a few documents
    assert packing.pack(docs_frame(spark, False)).collect() == []


def test_best_fit_places_everything():
    sizes = np.array([5, 7, 3, 10, 2, 2, 8, 1])
    place, offset, first = packing.best_fit(sizes, 10)
    assert len(first) == 4 and sizes.sum() == 38
    for b in range(len(first)):
        spans = sorted((offset[i], offset[i] + sizes[i]) for i in np.flatnonzero(place == b))
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and spans[-1][1] <= 10


def test_guests_find_hosts_up_the_tree(spark):
    data = [(i, "a " * (1499 if i % 2 else 399)) for i in range(300)]  # a long one has room for one short one
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(60, "doc_id")
    rows = packing.pack(docs).collect()
    assert len({r.sequence_id for r in rows}) <= 165  # 150 at best; alone, the partitions make over 180


def test_every_underfull_bin_can_be_a_host():
    """Neither nearly full bins nor those beyond the emptiest thousand are kept from the merges."""
    fill = np.array([*[1100] * 1500, *range(1101, 1401), 2000, 2047, 2048])
    up = packing._carried(fill, 2048, 0)
    assert set(fill[up]) == set(fill) - {2048}  # a bin of every fill but a full one
    assert (fill[up] == 1100).sum() >= packing.FAN


def test_a_guest_of_few_tokens_finds_a_nearly_full_host(spark):
    texts = ["a " * 2035, "b"]  # the long one leaves less than a 64th of the sequence
    docs = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(texts)), 2), "doc_id long, text string")
    assert len({r.sequence_id for r in packing.pack(docs).collect()}) == 1


@pytest.mark.parametrize("rule", tokens.RULES)
def test_allocation_rules(rule):
    # Sections [0, 3), [3, 4), [4, 9); tokens that cross one or both boundaries.
    starts, ends = np.array([0, 2, 3, 1, 5]), np.array([2, 4, 4, 8, 9])
    place, crossing = tokens.allocate(starts, ends, np.array([0, 3, 4]), rule)
    assert crossing.tolist() == [False, True, False, True, False]
    assert place.tolist() == {"start": [0, 0, 1, 0, 2], "end": [0, 1, 1, 2, 2], "most": [0, 0, 1, 2, 2]}[rule]


def test_token_counts_add_up(spark, reference):
    docs = docs_frame(spark)
    for rule, by in (("start", "line"), ("most", "line"), ("end", "field")):
        rows = tokens.count_tokens(docs, fields=("source", "text"), rule=rule, by=by).toPandas()
        total = rows.dropna(subset="doc_id").groupby("doc_id").agg(n=("n_tokens", "sum"), c=("n_chars", "sum"))
        for r in docs.where("doc_id IS NOT NULL").collect():
            whole = f"{r.source}\n{r.text or ''}"
            times = 2 if r.doc_id == 502 else 1
            assert total.n[r.doc_id] == times * len(reference.encode(whole, add_special_tokens=False).ids)
            assert total.c[r.doc_id] == times * len(whole)
    assert (rows.doc_id.isna().sum()) == 2
    assert tokens.count_tokens(docs_frame(spark, False)).collect() == []
    with pytest.raises(ValueError):
        tokens.count_tokens(docs, rule="half")


@pytest.mark.parametrize("text", ["", "\\", "a\\<s>", "<s>", "</s>[INST] ok [/INST]", "<<s>s>", "\\\\[INST]\\", "[/INST][INST]"])
def test_escaping_is_reversible(text):
    done = chat.escape(text)
    assert chat.unescape(done) == text and not any(c in done for c in chat.CONTROL)


def test_chat_reads_back(spark):
    rng = random.Random(9)
    data = []
    for conv in range(40):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "<s>"])
            data.append((conv, turn, role, rng.choice([*odd_texts(20), "</s>[INST] ok [/INST]", "\\", None])))
    data += [(50, 0, None, "no role"), (50, 0, "assistant", "tie b"), (50, 0, "assistant", "tie a"), (51, 0, "assistant", "twice"),
             (51, 0, "assistant", "twice"), (None, 0, "assistant", "no conversation"), (52, None, "user", "no turn"), (52, 1, "assistant", "é")]
    rng.shuffle(data)
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in data],
                                  "conv_id long, turn long, role string, text string, head int, ids string, conv long")
    formatted = chat.format_turns(frame)
    got = {r.conv: r for r in chat.read_back(formatted).collect()}
    conversations = {}
    for c, t, role, text in data:
        conversations.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(conversations)
    for c, turns in conversations.items():
        turns.sort()
        learned = "".join(x for _, role, x in turns if role == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(turns), len(learned))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        whole = "".join(r.formatted for r in sorted(formatted.where(
            "conv IS NULL" if c is None else f"conv = {c}").collect(), key=lambda r: r.token_start)) if c in (50, 51, None) else None
        assert whole is None or len(whole) == got[c].formatted_chars
    assert chat.read_back(chat.format_turns(frame.limit(0))).collect() == []


def test_toxicity_learns_stems(spark):
    rng = random.Random(4)
    syllables = ["ba", "ke", "lo", "mi", "su", "ta", "re", "no"]
    word = lambda n=3: "".join(rng.choice(syllables) for _ in range(rng.randint(1, n)))
    data, labels = [], []
    for i in range(900):
        w = [word() for _ in range(rng.randint(20, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(["vexor", "grulp" + word(2)])  # forms not seen before
        data.append((i, " ".join(w), rng.choice(["en", "de"]), "s", 0))
        labels.append((i, int(toxic)))
    data += [(2000, None, None, None, None), (2001, "", "en", "s", 0), (2001, "", "en", "s", 0), (None, "vexor", "en", "s", 0)]
    labels += [(5, None), (1, 0), (None, 1), (3, 0), (3, 1)]
    docs = spark.createDataFrame(data, SCHEMA)
    out = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), held_out="id % 4 = 2").toPandas()
    assert len(out) == len(data) and out.score.between(0, 1).all()
    held = out[out.held_out & (out.doc_id < 900)]
    truth = held.doc_id % 5 == 0
    assert ((held.score >= 0.3) == truth).mean() > 0.95
    none = toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).toPandas()
    assert (none.score == 0).all() and not none.toxic.any()


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Of 3,400 toxic rows the last 400 by hash have a word of their own, which must be learned."""
    monkeypatch.setattr(toxicity, "WARM", 800, raising=False)
    ids = [r.id for r in spark.range(4000).selectExpr("id").orderBy(F.xxhash64("id")).collect()]
    rng = random.Random(2)
    data = []
    for place, i in enumerate(ids):
        other = [rng.choice(["bako", "lemi", "suta", "reno"]) for _ in range(4)]
        data.append((i, " ".join([*other, "zargle" if place >= 3600 else "vexor" if place >= 600 else "milo"]), "en", int(place >= 600)))
    docs = spark.createDataFrame([(i, t, x, "s", 0) for i, t, x, _ in data], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, *_, y in data], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    late, clean = [got[i] for i in ids[3600:]], [got[i] for i in ids[:600]]
    assert min(late) > 0.9 and max(clean) < 0.3


def test_language_backoff(spark):
    rng = random.Random(6)
    syllables = {"aa": ["ka", "to", "mi"], "bb": ["str", "eng", "olf"], "cc": ["ção", "lhe", "que"]}
    data = []
    for i in range(300):
        lang = rng.choice(sorted(syllables))
        data.append((i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(2, 5))) for _ in range(12)), lang, "s", 0))
    data += [(400, None, "aa", "s", 0), (401, "123 !!", "aa", "s", 0), (402, "katomi", None, "s", 0), (402, "katomi", None, "s", 0)]
    docs = spark.createDataFrame(data, SCHEMA)
    model = langid.learn(docs.where("doc_id % 5 <> 0").select("text", "lang"))
    out = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(out[i].lang_pred == lang for i, _, lang, _, _ in data[:300] if i % 5 == 0)
    assert (out[400].lang_pred, out[401].lang_pred, out[402].lang_pred) == ("und", "und", "aa")
    empty = langid.learn(docs.limit(0).select("text", "lang"))
    assert empty.predict("katomi") == ("und", 0.0)


def plain_language(train, text, orders=(4, 3, 2, 1)):
    """Word-first backoff in full, by dictionaries of counts."""
    import math
    from collections import Counter

    words = {}
    for t, lang in train:
        words.setdefault(lang, Counter()).update(re.findall(r"[^\W\d_]+", t.lower()))
    grams = {lang: {k: Counter() for k in orders} for lang in words}
    for lang, n in words.items():
        for w, c in n.items():
            for k in orders:
                for i in range(len(w) + 3 - k):
                    grams[lang][k][f"^{w}$"[i:i + k]] += c

    def log(n, unit):
        return math.log(n[unit] + 0.5) - math.log(n.total() + 0.5 * len(n))

    total = dict.fromkeys(sorted(words), 0.0)
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        if any(w in n for n in words.values()):
            for lang in total:
                total[lang] += log(words[lang], w)
            continue
        full = f"^{w}$"
        for i in range(len(full)):
            for k in orders:
                if i + k <= len(full) and any(full[i:i + k] in grams[x][k] for x in words):
                    for lang in total:
                        total[lang] += log(grams[lang][k], full[i:i + k])
                    break
    best = max(total, key=lambda x: total[x])
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


@pytest.mark.parametrize("max_words", [2_000_000, 1])
def test_language_scores_equal_plain_counts(spark, max_words):
    """A model for broadcast and one that stays in tables score alike."""
    rng = random.Random(9)
    words = {"aa": ["kato", "mito", "toka", "do"], "b'b": ["streng", "olf", "eng", "do"], "rare": ["ção", "lhe"]}
    train = [(" ".join(rng.choice(words[x]) for _ in range(rng.randrange(1, 9))), x) for x in ["aa"] * 30 + ["b'b"] * 12 + ["rare"] * 2]
    texts = [t for t, _ in train] + ["tokado strolf", "lhe", "kato kato olf unseen", "çã", "zzz", "DO Mito", "x" * 30_000, "lhe " * 3000]
    model = langid.learn(spark.createDataFrame(train + [("ignored", None), (None, "aa")], "text string, lang string"), max_words=max_words)
    assert isinstance(model, langid.Tables) == (max_words == 1)
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "²³ ½ Ⅷ"), (903, "12 _"), (None, "kato"), (None, "kato")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang_pred string, n int")
    out = langid.identify(docs, model).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    for i, t in enumerate(texts):
        lang, score = plain_language(train, t)
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-4, t[:30]
    assert {(got[i].lang_pred, got[i].score) for i in (900, 901, 902, 903)} == {("und", 0.0)}
    assert got[None].lang_pred == "aa"


def pages(spark):
    data = [(1, "u", "aa"), (2, "u\r\nWARC-Type: x", "aa"), (3, None, ""), (4, "v", None), (5, "w", "b" * 200_000), (6, "z", "b" * 200_000),
            (7, "q", "\r\n\r\nWARC/1.1 é\r\n\r\n"), (1, "u", "aa"), (None, "n", "aa"), (8, "8", "aa")]
    return spark.createDataFrame([(*r, 1, "x") for r in data], "page_id long, url string, html string, id int, payload string").repartition(3)


def test_warc_round_trip(spark, tmp_path):
    warc.write_pages(pages(spark), str(tmp_path / "a"))
    rows = warc.read_warc(spark, str(tmp_path / "a")).collect()
    by = sorted((r.record_id, r.record_type, r.refers_to, r.payload_length) for r in rows)
    name = "<urn:page:{}>".format
    assert by == sorted([
        (name(1), "response", None, 2), (name(1), "response", None, 2), (name(2), "revisit", name(1), 2), (name(3), "response", None, 0),
        (name(4), "revisit", name(3), 0), (name(5), "response", None, 200_000), (name(6), "revisit", name(5), 200_000),
        (name(7), "response", None, 19), (name(8), "revisit", name(1), 2), (name(""), "response", None, 2)], key=lambda x: x)
    assert {bytes(r.payload) for r in rows if r.record_type == "response"} == {b"aa", b"", b"b" * 200_000, "\r\n\r\nWARC/1.1 é\r\n\r\n".encode()}
    few = warc.read_warc(spark, str(tmp_path / "a"), payload=False).where("record_type = 'revisit' AND target_uri IN ('z', 'v')")
    assert "Filter (" not in few._jdf.queryExecution().executedPlan().toString()  # pushed down whole
    assert sorted(r.record_id for r in few.collect()) == [name(4), name(6)]
    # Files that no commit lists do not count.
    (tmp_path / "a" / "part-lost.warc.gz").write_bytes(b"junk")
    assert warc.read_warc(spark, str(tmp_path / "a")).count() == 10


@pytest.mark.parametrize("kind", ["plain", "members", "one member"])
def test_warc_other_layouts(spark, tmp_path, kind):
    import gzip

    data = [warc.record({"record_type": "response", "record_id": f"<urn:page:{i}>", "payload": bytes([65 + i]) * (70_000 * i)}) for i in range(5)]
    path = tmp_path / ("x.warc" if kind == "plain" else "x.warc.gz")
    path.write_bytes({"plain": b"".join(data), "members": b"".join(map(gzip.compress, data)), "one member": gzip.compress(b"".join(data))}[kind])
    assert [len(r.payload) for r in warc.read_warc(spark, str(path)).orderBy("record_id").collect()] == [70_000 * i for i in range(5)]
    lengths = warc.read_warc(spark, str(path), payload=False).where("record_id > '<urn:page:1>'").orderBy("record_id").collect()
    assert [r.payload_length for r in lengths] == [140_000, 210_000, 280_000]
    one = warc.read_warc(spark, str(path)).where("record_id = '<urn:page:3>'").collect()
    assert len(one) == 1 and one[0].payload == b"D" * 210_000


def test_warc_query_with_null_ids(spark, tmp_path):
    pages(spark).select("page_id", "url", "html").write.parquet(str(tmp_path / "pages.parquet"))
    rows = warc.op10_warc(spark, str(tmp_path)).collect()
    assert len(rows) == 10 and [r.payload_bytes for r in rows if r.page_id is None] == [2]


def test_warc_edges(spark, tmp_path):
    warc.write_pages(pages(spark).limit(0), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).collect() == []
    warc.write_pages(pages(spark), str(tmp_path / "b"), least_bytes=3)
    kinds = {r.record_id: r.record_type for r in warc.read_warc(spark, str(tmp_path / "b")).collect()}
    assert [k for k, v in kinds.items() if v == "revisit"] == ["<urn:page:6>"]
