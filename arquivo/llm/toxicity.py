"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is that of its hash plus the mean of those of its hashed character
n-grams, so unseen forms of a known stem have a like vector. Filters over one, two and
three words are rectified and max-pooled over the whole text; a logistic layer scores the
maxima. Scores are calibrated (Platt) to the share of toxic labels, and a threshold for each
language is chosen on the rows kept back for calibration.

Every labelled row teaches, and all training runs in tasks. One task goes over the first ``WARM``
rows (by hash) up to ``EPOCHS`` times, so that the filters take shape; then all others are learned
in ``ROUNDS`` rounds, in which every partition goes on from the model of the round before. A round's
steps are averaged over the partitions that touched a parameter, in a tree of merges by blocks of
parameters; the driver gets their result, whose size is that of the model. Calibration and
thresholds use counts of the scores of all rows kept back, a thousandth of a logit apart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common

WIDTHS = (1, 2, 3)
WORD = re.compile(r"[^\W\d_]+")
MEMO = 500_000  # word vectors remembered by a Python worker
CHUNK = 4096  # words convolved at once
WARM, EPOCHS, ROUNDS = 4000, 8, 2
TEXTS, WORDS = 4000, 4_000_000  # learned from at once, by a task in bounded memory
BLOCK, FAN = 4096, 16  # embedding rows merged by a group, partitions merged at once


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _rows(word: str, size: int) -> list[int]:
    """The embedding rows of a word: its own hash, then its n-grams (of bytes)."""
    full, crc = f"^{word}$".encode(), zlib.crc32
    return [crc(b"w " + full) % size, *[crc(full[i : i + 4]) % size for i in range(len(full) - 3)],
            *[crc(full[i : i + 5]) % size for i in range(len(full) - 4)]]


def _side_by_side(words: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of all words in one array, where each word's begin, and how many it has."""
    rows = [_rows(w, size) for w in words]
    count = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(chain.from_iterable(rows), np.int64, int(count.sum())), np.cumsum(count) - count, count


class Cnn:
    def __init__(self, seed: int = 7, size: int = 1 << 17, dims: int = 16, filters: int = 8):
        rng = np.random.default_rng(seed)
        self.size, self.dims, self.filters = size, dims, filters
        self.table = rng.normal(0, 0.1, (size, dims)).astype(np.float32)
        self.conv = [rng.normal(0, 0.3, (w, dims, filters)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), filters), np.float32)
        self.out = rng.normal(0, 0.3, (len(WIDTHS), filters)).astype(np.float32)
        self.base = np.float32(0)
        self.scale, self.shift = 1.0, 0.0
        self.at: dict[str, int] = {}
        self.vectors = np.zeros((1024, dims), np.float32)
        self.seen: list[np.ndarray] = []  # Adagrad's sums, while the model learns

    def __getstate__(self):
        return self.__dict__ | {"at": {}, "vectors": np.zeros((1024, self.dims), np.float32)}

    def embeddings(self, flat: np.ndarray, starts: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The vectors of words whose rows lie side by side in ``flat``: their own row plus
        the mean of the others."""
        own = self.table[flat[starts]]
        whole = np.add.reduceat(self.table[flat], starts, axis=0)
        return own + (whole - own) / np.maximum(count - 1, 1)[:, None].astype(np.float32)

    def embed(self, words: list[str]) -> np.ndarray:
        at = self.at
        if len(at) > MEMO:
            at.clear()
        found = list(map(at.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, k in zip(words, found) if k is None))
            have = len(at)
            while have + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[have : have + len(new)] = self.embeddings(*_side_by_side(new, self.size))
            at.update(zip(new, range(have, have + len(new))))
            found = list(map(at.get, words))
        return self.vectors[found]

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maxima over a text of every filter, rectified, and where they are (-1: zero)."""
        best = np.zeros((len(WIDTHS), self.filters), np.float32)
        where = np.full(best.shape, -1)
        for k, w in enumerate(WIDTHS):
            for a in range(0, len(x) - w + 1, CHUNK):  # long texts in bounded memory
                m = min(CHUNK, len(x) - w + 1 - a)
                y = x[a : a + m] @ self.conv[k][0]
                for j in range(1, w):
                    y += x[a + j : a + j + m] @ self.conv[k][j]
                top = y.argmax(axis=0)
                value = y[top, np.arange(self.filters)] + self.bias[k]
                more = value > best[k]
                best[k][more], where[k][more] = value[more], top[more] + a
        return best, where

    def logit(self, words: list[str]) -> float:
        return float((self.pooled(self.embed(words))[0] * self.out).sum() + self.base)

    def score(self, logit: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * logit + self.shift, -30, 30))))

    def fit(self, texts: list[list[str]], y: np.ndarray, weight: np.ndarray, epochs: int = 8, rate: float = 0.1,
            seed: int = 7) -> None:
        """Adagrad on single texts; only embeddings at a maximum have a gradient. Further calls go on
        from the sums of those before."""
        known = list(dict.fromkeys(w for t in texts for w in t))
        number = {w: i for i, w in enumerate(known)}
        ids = [np.fromiter(map(number.get, t), np.int64, len(t)) for t in texts]
        if not known:
            return
        flat, starts, count = _side_by_side(known, self.size)
        if not self.seen:
            self.seen = [np.full_like(p, 1e-6) for p in (self.table, *self.conv, self.bias, self.out)] + [np.full(1, 1e-6, np.float32)]
        seen = self.seen
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            # Vectors as of the epoch's start; those of words at a maximum are always fresh.
            vectors = np.concatenate([self.embeddings(flat[starts[a] : starts[a] + count[a : a + 50_000].sum()],
                                                      starts[a : a + 50_000] - starts[a], count[a : a + 50_000])
                                      for a in range(0, len(known), 50_000)])
            for i in rng.permutation(len(texts)):
                x = vectors[ids[i]]
                best, where = self.pooled(x)
                z = np.clip((best * self.out).sum() + self.base, -30, 30)
                g = np.float32((1 / (1 + np.exp(-z)) - y[i]) * weight[i])
                if abs(g) < 1e-3:
                    continue
                d_out, d_best = g * best, g * self.out
                touched: dict[int, np.ndarray] = {}
                for k, w in enumerate(WIDTHS):
                    d_conv = np.zeros_like(self.conv[k])
                    d_bias = np.zeros(self.filters, np.float32)
                    for f in np.flatnonzero(where[k] >= 0):
                        a = where[k][f]
                        d_bias[f] = d_best[k, f]
                        d_conv[:, :, f] = d_best[k, f] * x[a : a + w]
                        for j in range(w):
                            word = int(ids[i][a + j])
                            touched[word] = touched.get(word, 0) + d_best[k, f] * self.conv[k][j, :, f]
                    seen[1 + k] += d_conv ** 2
                    self.conv[k] -= rate * d_conv / np.sqrt(seen[1 + k])
                    seen[-3][k] += d_bias ** 2
                    self.bias[k] -= rate * d_bias / np.sqrt(seen[-3][k])
                seen[-2] += d_out ** 2
                self.out -= rate * d_out / np.sqrt(seen[-2])
                seen[-1] += g * g
                self.base -= np.float32(rate * g / np.sqrt(seen[-1][0]))
                for word, d in touched.items():
                    r = flat[starts[word] : starts[word] + count[word]]
                    share = np.full((len(r), 1), 1 / max(1, len(r) - 1), np.float32)
                    share[0] = 1
                    step = share * d
                    np.add.at(seen[0], r, step ** 2)
                    np.add.at(self.table, r, -rate * step / np.sqrt(seen[0][r]))
                    vectors[word] = self.embeddings(r, np.zeros(1, np.int64), np.array([len(r)]))[0]

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """All parameters but the embeddings, and their sums, each side by side."""
        own = [*self.conv, self.bias, self.out, np.array([self.base], np.float32)]
        return np.concatenate([p.ravel() for p in own]), np.concatenate([p.ravel() for p in self.seen[1:]])

    def step(self, rows: np.ndarray, by: np.ndarray, seen: np.ndarray) -> None:
        """Add to embedding rows and their sums; to all other parameters if ``rows`` is [-1]."""
        if rows[0] >= 0:
            self.table[rows] += by
            self.seen[0][rows] += seen
            return
        at = 0
        for p, q in zip([*self.conv, self.bias, self.out], self.seen[1:]):
            p += by[0, at : at + p.size].reshape(p.shape)
            q += seen[0, at : at + p.size].reshape(p.shape)
            at += p.size
        self.base += by[0, -1]
        self.seen[-1] += seen[0, -1]

    def calibrate(self, logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Platt scaling by Newton steps on weighted rows, with smoothed targets."""
        pos, neg = (weight * y).sum(), (weight * (1 - y)).sum()
        target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
        spread = max(1e-6, float(np.abs(logits).max()))
        a, b, x = 1.0, 0.0, logits / spread
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            d, h = weight * (p - target), weight * p * (1 - p) + 1e-9
            grad = np.array([(d * x).sum() + 1e-3 * a, d.sum()])
            hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum()]])
            a, b = np.array([a, b]) - np.clip(np.linalg.solve(hess + 1e-9 * np.eye(2), grad), -3, 3)
        self.scale, self.shift = max(0.0, a) / spread, b


def _best_threshold(score: np.ndarray, hits: np.ndarray, n: np.ndarray) -> float:
    """The threshold with the best F1, from distinct scores, their toxic rows and all their
    rows; between two scores, their middle."""
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum(hits[order])
    f1 = 2 * hit / (np.cumsum(n[order]) + max(1, hits.sum()))
    f1[:-1][s[:-1] == s[1:]] = 0
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k] / 2)


DELTA = "block int, part int, rows binary, n binary, by binary, seen binary"


def _packed(block: int, part: int, rows: np.ndarray, n: np.ndarray, by: np.ndarray, seen: np.ndarray) -> dict:
    return {"block": block, "part": part, "rows": rows.astype(np.int32).tobytes(), "n": n.astype(np.int32).tobytes(),
            "by": by.astype(np.float32).tobytes(), "seen": seen.astype(np.float32).tobytes()}


def _unpacked(r) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows = np.frombuffer(r["rows"], np.int32)
    by, seen = (np.frombuffer(r[c], np.float32).reshape(len(rows), -1) for c in ("by", "seen"))
    return rows, np.frombuffer(r["n"], np.int32), by, seen


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """The steps and sums of some partitions for one block of parameters, added up."""
    pdf = pdf.sort_values("part", ignore_index=True)  # the same sums whatever the order of arrival
    rows, n, by, seen = (np.concatenate(x) for x in zip(*(_unpacked(r) for r in pdf.to_dict("records"))))
    every, at = np.unique(rows, return_inverse=True)
    total = [np.zeros((len(every), *x.shape[1:]), np.float64) for x in (n, by, seen)]
    for t, x in zip(total, (n, by, seen)):
        np.add.at(t, at, x)
    return pd.DataFrame([_packed(int(pdf["block"][0]), int(pdf["part"][0]) // FAN, every, *total)])


def _learn(model: Cnn, rows: DataFrame, epochs: int, seed: int) -> None:
    """Let every partition of ``rows`` (id, y, weight, text) go on from ``model``, and add the
    mean of their steps to it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # its size is fixed by its parameters

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old = shared.value
        new, part = Cnn.__new__(Cnn), TaskContext.get().partitionId()
        new.__dict__ |= old.__getstate__() | {
            "table": old.table.copy(), "conv": [p.copy() for p in old.conv], "bias": old.bias.copy(), "out": old.out.copy(),
            "seen": [p.copy() for p in old.seen]}
        texts, y, weight, words = [], [], [], 0
        pool: dict[str, str] = {}  # equal words are one object

        def fit() -> None:
            new.fit(texts, np.array(y), np.array(weight), epochs, seed=seed)
            for x in (texts, y, weight, pool):
                x.clear()

        for batch in batches:
            for text, kind, w in zip(*(batch.column(c).to_pylist() for c in ("text", "y", "weight"))):
                texts.append([pool.setdefault(x, x) for x in words_of(text)])
                y.append(float(kind))
                weight.append(w)
                words += len(texts[-1])
                if len(texts) >= TEXTS or words >= WORDS:
                    fit()
                    words = 0
        if texts:
            fit()
        if not new.seen:
            return
        first = old.seen or [np.full_like(p, 1e-6) for p in new.seen]
        out = []
        for block, a in enumerate(range(0, new.size, BLOCK)):
            touched = np.flatnonzero((new.seen[0][a : a + BLOCK] != first[0][a : a + BLOCK]).any(axis=1)) + a
            if len(touched):
                out.append(_packed(block, part, touched, np.ones(len(touched)), new.table[touched] - old.table[touched],
                                   new.seen[0][touched] - first[0][touched]))
        begun = Cnn.__new__(Cnn)
        begun.__dict__ |= old.__getstate__() | {"seen": first}
        (p, q), (p0, q0) = new.flat(), begun.flat()
        out.append(_packed(-1, part, np.array([-1]), np.ones(1), p - p0, q - q0))
        for r in out:
            yield pa.RecordBatch.from_pylist([r], schema=kinds)

    kinds = pa.schema([("block", pa.int32()), ("part", pa.int32()), *((c, pa.binary()) for c in ("rows", "n", "by", "seen"))])
    steps = common.settle(rows.mapInArrow(local, DELTA), "toxicity-steps")
    parts = (steps.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        before = steps
        steps = common.settle(before.groupBy("block", F.expr(f"part div {FAN}").alias("group")).applyInPandas(_merge, DELTA), "toxicity-steps")
        common.free(before)
        parts = -(-parts // FAN)
    if not model.seen:
        model.seen = [np.full_like(p, 1e-6) for p in (model.table, *model.conv, model.bias, model.out)] + [np.full(1, 1e-6, np.float32)]
    for r in steps.collect():  # as many numbers as the model has, twice
        at, n, by, seen = _unpacked(r)
        model.step(at, by / n[:, None].astype(np.float32), seen)
    common.free(steps)
    shared.unpersist()


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """(id, text, lang, y, back) of the labelled rows, an id once; ``back``: kept back to calibrate."""
    rows = rows.where("id IS NOT NULL")
    again = common.settle(rows.groupBy("id").agg(F.count("*").alias("m")).where("m > 1").select("id"), "toxicity-again")
    n, n_label = again.count(), label.count()
    once = common.join_counted(rows, again, "id", "left_anti", n)  # only rows that share an id are shuffled
    more = common.join_counted(rows, again, "id", "left_semi", n).groupBy("id").agg(F.min(F.struct("text", "lang")).alias("r")).select("id", "r.*")
    every = common.join_counted(once.union(more), label, "id", "inner", n_label)
    taught = common.settle(every.withColumn("back", F.expr("crc32(concat('back ', cast(id AS STRING))) % 5 = 0")), "toxicity-rows")
    common.free(again)
    return taught


def train(rows: DataFrame, label: DataFrame, seed: int = 7) -> tuple[Cnn | None, dict[str, float]]:
    """Fit on all of ``rows`` (id, text, lang) that ``label`` (id, y; an id once) has. A fifth of
    them is kept back to calibrate. Returns the model (None without rows of both kinds) and
    the thresholds by language ('' for all)."""
    label = common.settle(label, "toxicity-labels")
    taught = _labelled(rows, label)
    count = {(r["y"], r["back"]): r["count"] for r in taught.groupBy("y", "back").count().collect()}
    n = {y: count.get((y, False), 0) + count.get((y, True), 0) for y in (0, 1)}
    if not all(n.values()):
        common.free(label, taught)
        return None, {}
    apart = len(count) == 4  # both kinds on both sides
    fit = taught.where("NOT back") if apart else taught
    n = {y: count[y, False] for y in (0, 1)} if apart else n
    fit = fit.select("id", "y", F.expr(f"IF(y = 1, {min(n[0] / n[1], 3.0)!r}D, 1D)").alias("weight"), "text", F.xxhash64("id").alias("k"))
    model, total = Cnn(seed), sum(n.values())
    # By the hash of an id: the warm-up's rows, and the round in which any other is learned.
    turn = f"IF(pmod(k, {total}) < {WARM}, -1, pmod(xxhash64(k), {ROUNDS}))" if total > WARM else "-1"
    for i in range(-1, ROUNDS if total > WARM else 0):
        some = fit.where(f"{turn} = {i}")
        some = some.repartition(1) if i < 0 else some  # about WARM rows
        _learn(model, some.sortWithinPartitions("k", "id").drop("k"), EPOCHS if i < 0 else 1, seed + i + 1)
    model.seen = []
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def logit(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.logit(words_of(t)) for t in texts], dtype="float64")

    held = (taught.where("back") if apart else taught).select("lang", "y", F.round(logit("text") * 1000).cast("long").alias("z"))
    held = common.settle(held.groupBy("lang", "z").agg(F.sum("y").alias("hits"), F.count("*").alias("n")), "toxicity-logits")
    some = held.groupBy("z").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).orderBy("z").toPandas()
    z = some["z"].to_numpy(np.float64) / 1000
    hits, of = some["hits"].to_numpy(np.float64), some["n"].to_numpy(np.float64)
    model.calibrate(np.tile(z, 2), np.repeat([1.0, 0.0], len(z)), np.concatenate([hits, of - hits]))
    cuts = {"": _best_threshold(np.array([model.score(x) for x in z]), hits, of)}
    enough = held.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("hits").alias("h"), F.sum("n").alias("m")).where("h >= 5 AND m - h >= 5")
    by_lang = held.join(enough.select("lang"), "lang").toPandas().sort_values(["lang", "z"])
    for lang, own in by_lang.groupby("lang"):
        cuts[lang] = _best_threshold(np.array([model.score(x / 1000) for x in own["z"]]), own["hits"].to_numpy(np.float64), own["n"].to_numpy(np.float64))
    common.free(label, taught, held)
    return model, cuts


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             held_out: str = "false") -> DataFrame:
    """(id, held_out, score, toxic) of every row: the score of its whole text, and whether
    it reaches its language's threshold (languages with too few labels: that of all).

    ``labels``: id and ``toxic`` (1 or 0). Rows for which the SQL condition ``held_out`` (on
    ``id``) holds, null labels, ids with both labels and rows with a null id teach nothing.
    Null texts have no words, as empty ones, and are scored all the same. Without labels of
    both kinds every score is 0. Repeated rows are scored alike.
    """
    common.importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    label = (labels.select(F.col(id_col).alias("id"), F.col("toxic").alias("t")).where("t IN (0, 1) AND id IS NOT NULL")
             .groupBy("id").agg(F.min("t").alias("y"), F.max("t").alias("most")).where("y = most")
             .where(f"NOT coalesce({held_out}, false)").select("id", "y"))
    model, cuts = train(rows, label)
    if model is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, fixed by its parameters

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            m = shared.value
            return pd.Series([m.score(m.logit(words_of(t))) for t in texts], dtype="float64")

        scored = rows.withColumn("score", score("text"))
    by_lang = "CASE lang " + " ".join(
        f"WHEN {_quoted(k)} THEN {v!r}D" for k, v in sorted(cuts.items()) if k) + f" ELSE {cuts.get('', 2.0)!r}D END"
    limit = F.expr(by_lang) if len(cuts) > 1 else F.lit(cuts.get("", 2.0))
    return scored.select(F.col("id").alias(id_col), F.expr(f"coalesce({held_out}, false)").alias("held_out"), "score",
                         (F.col("score") >= limit).alias("toxic"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out (crc32 of the id's text mod 4 is 2), score, predicted (score >= 0.3),
    and toxic by the threshold of the row's language."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity(docs, labels, held_out="crc32(cast(id AS STRING)) % 4 = 2")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "toxic")
