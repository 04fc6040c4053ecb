"""Language identification by word-first backoff.

Known words are scored by their log frequency in every language. A word that is not known
is taken letter by letter: from each place the longest known character n-gram (four letters
down to one) is scored by its log frequency among n-grams of its length.

Every word and n-gram of the training texts is in the model, with its counts. While there are
at most ``max_words`` and ``max_grams`` kinds the model is broadcast, as sorted 64-bit hashes and
their log frequencies (24 bytes each with four languages). A larger model stays in tables, and the texts' words are
counted by document and joined with them; both ways score alike.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common

ORDERS = (4, 3, 2, 1)
WORD = re.compile(r"[^\W\d_]+")
#: Signs of other categories (as superscripts) that Python counts as word characters.
NO_LETTERS = frozenset(
    c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isdecimal() and unicodedata.category(c)[0] != "L")
UNDETERMINED = "und"
MEMO = 200_000


def counts(training: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n) and (lang, gram, n) over all texts of ``training`` (text, lang). Word
    ends are part of n-grams, as ``^`` and ``$``."""
    word = (training.where("lang IS NOT NULL")
            .select("lang", F.explode_outer(F.expr("split(lower(text), '[^\\\\p{L}]+', -1)")).alias("word"))
            .where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n")))
    word = common.settle(word, "langid-words")
    padded = word.select("lang", "n", F.concat(F.lit("^"), "word", F.lit("$")).alias("p"))
    gram = padded.select("lang", "n", F.explode_outer(F.expr("flatten(array(" + ", ".join(
        f"IF(length(p) >= {k}, transform(sequence(1, length(p) - {k - 1}), i -> substr(p, i, {k})), array())" for k in ORDERS)
        + "))")).alias("gram"))
    return word, gram.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def letter_runs(text: str) -> list[str]:
    if not text.isascii() and not NO_LETTERS.isdisjoint(text):
        text = "".join(" " if c in NO_LETTERS else c for c in text)
    return WORD.findall(text)


def _hashes(units: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(u.encode(), 42) for u in units], np.uint64).view(np.int64)


def _find(known: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """The places of hashes among sorted ones; -1: not there."""
    k = np.searchsorted(known, hashed)
    if not len(known):
        return np.full(len(hashed), -1)
    return np.where(known[np.minimum(k, len(known) - 1)] == hashed, k, -1)


class Model:
    """A model for broadcast: sorted hashes of words and of n-grams, and their log frequencies."""

    def __init__(self, langs: list[str], words: np.ndarray, word_logs: np.ndarray, grams: np.ndarray, gram_logs: np.ndarray):
        self.langs, self.words, self.word_logs, self.grams, self.gram_logs = langs, words, word_logs, grams, gram_logs
        self.place: dict[str, int] = {}
        self.memo: dict[str, list[int]] = {}

    def __getstate__(self):
        return self.__dict__ | {"place": {}, "memo": {}}

    def places(self, found: list[str]) -> np.ndarray:
        """The numbers of words in the model; of unknown ones -1."""
        at = list(map(self.place.get, found))
        new = list({w for w, k in zip(found, at) if k is None})
        if new:
            own = dict(zip(new, _find(self.words, _hashes(new)).tolist()))
            if len(self.place) > MEMO:
                self.place.clear()
            self.place |= own
            at = [own[w] if i is None else i for w, i in zip(found, at)]
        return np.array(at)

    def parts(self, word: str) -> list[int]:
        """The longest known n-grams of a word, one from each place."""
        full = f"^{word}$"
        place = np.full(len(full), -1)
        for k in sorted(ORDERS):  # longer ones replace shorter ones
            runs = [full[i:i + k] for i in range(len(full) - k + 1)]
            found = _find(self.grams, _hashes(runs))
            place[: len(runs)] = np.where(found >= 0, found, place[: len(runs)])
        return place[place >= 0].tolist()

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share of probability among those learned (equal priors)."""
        found = letter_runs((text or "").lower())
        if not found or not self.langs:
            return UNDETERMINED, 0.0
        at = self.places(found)
        total = self.word_logs[at[at >= 0]].sum(axis=0, dtype=np.float64)
        if (at < 0).any():
            if len(self.memo) > MEMO:
                self.memo.clear()
            grams: list[int] = []
            for i in np.flatnonzero(at < 0):
                word = found[i]
                g = self.memo.get(word)
                if g is None:
                    g = self.memo[word] = self.parts(word)
                grams += g
            total = total + self.gram_logs[grams].sum(axis=0, dtype=np.float64)
        share = np.exp(total - total.max())
        best = int(total.argmax())
        return self.langs[best], float(share[best] / share.sum())


class Tables:
    """The same model as tables (word, logs) and (gram, logs)."""

    def __init__(self, langs: list[str], words: DataFrame, grams: DataFrame):
        self.langs, self.words, self.grams = langs, words, grams


def _logs(table: DataFrame, unit: str, langs: list[str], whole: dict, key: str = "") -> DataFrame:
    """(unit, logs): by language the log of (count + 1/2) / (all + kinds / 2); ``whole`` has all and
    kinds by (language, value of the SQL ``key``)."""
    wide = table.groupBy(unit).pivot("lang", langs).agg(F.sum("n"))
    logs = []
    for lang in langs:
        by = {k: n + 0.5 * kinds for (x, k), (n, kinds) in whole.items() if x == lang}
        base = "CASE " + " ".join(f"WHEN {key} = {k} THEN ln({v!r}D)" for k, v in by.items()) + " ELSE ln(1.5D) END" if key else f"ln({by[None]!r}D)"
        logs.append(F.log(F.coalesce(F.col(f"`{lang}`"), F.lit(0)) + 0.5) - F.expr(base))
    return wide.select(unit, F.array(*logs).alias("logs"))


def learn(training: DataFrame, max_words: int = 4_000_000, max_grams: int = 2_000_000) -> Model | Tables:
    """Count all words and n-grams of ``training`` (text, lang): a model for broadcast if there are
    at most ``max_words`` and ``max_grams`` kinds of them, else its tables."""
    word, gram = counts(training)
    gram = common.settle(gram, "langid-grams")
    whole = {(r["lang"], None): (r["n"], r["k"]) for r in word.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()}
    per = {(r["lang"], r["k"]): (r["n"], r["kinds"]) for r in
           gram.groupBy("lang", F.length("gram").alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    langs = sorted(x for x, _ in whole)
    if not langs:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0, np.int64), np.zeros((0, 0), np.float32))
    words = common.settle(_logs(word, "word", langs, whole), "langid-word-logs")
    grams = common.settle(_logs(gram, "gram", langs, per, "length(gram)"), "langid-gram-logs")
    if words.count() > max_words or grams.count() > max_grams:
        return Tables(langs, words, grams)

    def collected(table: DataFrame, unit: str) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes and their logs: 8 bytes, and 4 for each language."""
        rows = table.select(F.xxhash64(unit).alias("h"), F.col("logs").cast("array<float>").alias("logs")).toArrow()
        hashed = rows["h"].to_numpy()
        order = np.argsort(hashed)
        return hashed[order], rows["logs"].combine_chunks().flatten().to_numpy().reshape(-1, len(langs))[order]

    return Model(langs, *collected(words, "word"), *collected(grams, "gram"))


def _by_tables(docs: DataFrame, model: Tables, id_col: str, text_col: str) -> DataFrame:
    """``identify`` by joins. A word's rows are one a document, so a frequent one is a large join key,
    which adaptive execution splits."""
    langs = range(len(model.langs))
    keyed = common.settle(docs.select(F.col(id_col), F.col(text_col).alias("_text")).withColumn("_row", F.monotonically_increasing_id()), "langid-rows")
    word = (keyed.select("_row", F.explode(F.expr("split(lower(_text), '[^\\\\p{L}]+', -1)")).alias("word")).where("word <> ''")
            .groupBy("_row", "word").agg(F.count("*").alias("n")))
    found = common.settle(word.join(model.words, "word", "left"), "langid-found")
    new = found.where("logs IS NULL").select("word").distinct().withColumn("p", F.expr("concat('^', word, '$')"))
    place = new.select("word", "p", F.explode(F.expr("sequence(1, length(p))")).alias("i"))
    run = place.select("word", "i", F.explode(F.expr(
        f"filter(transform(array({', '.join(map(str, ORDERS))}), k -> substr(p, i, k)), (g, j) -> length(g) = {ORDERS[0]} - j)")).alias("gram"))
    longest = run.join(model.grams, "gram").groupBy("word", "i").agg(F.expr("max_by(logs, length(gram))").alias("logs"))
    summed = longest.groupBy("word").agg(F.array(*(F.sum(F.col("logs")[i]) for i in langs)).alias("parts"))
    scored = (found.join(summed, "word", "left")
              .select("_row", "n", F.coalesce("logs", "parts", F.array(*(F.lit(0.0) for _ in langs))).alias("logs"))
              .groupBy("_row").agg(F.array(*(F.sum(F.col("n") * F.col("logs")[i]) for i in langs)).alias("t")))
    names = "array(" + ", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in model.langs) + ")"
    return (keyed.join(scored, "_row", "left").withColumn("_max", F.expr("array_max(t)")).select(
        id_col, F.expr(f"coalesce(get({names}, cast(coalesce(array_position(t, _max), 0) - 1 AS INT)), '{UNDETERMINED}')").alias("lang_pred"),
        F.expr("coalesce(1 / aggregate(t, 0D, (s, x) -> s + exp(x - _max)), 0D)").alias("score")))


def identify(docs: DataFrame, model: Model | Tables, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row's whole text. Null texts, texts without a letter
    and any text under a model that learned no language: ``und`` with score 0. Ties go to
    the language that sorts first; repeated rows are decided alike."""
    if isinstance(model, Tables):
        return _by_tables(docs, model, id_col, text_col)
    common.importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # counted, see learn

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.select(F.col(id_col), predict(F.col(text_col)).alias("p")).select(id_col, "p.lang_pred", "p.score")


def op8_langid(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out (crc32 of the id's text mod 5 is 0), lang_pred, score; learned from
    the rows not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.expr("coalesce(crc32(cast(doc_id AS STRING)) % 5 = 0, false)")
    model = learn(docs.where(~held).select("text", "lang"))
    return identify(docs, model).withColumn("held_out", held)
