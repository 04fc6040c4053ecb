"""Spelling variants by a bit-sliced position index over the vocabulary.

Words of the texts are counted with DataFrame functions. Two words are near if they differ by
exactly one inserted, deleted or replaced code point.

Near words of which the shorter has m code points share their first h or their last m - h, for
any h: a word is filed, for both m (its own length, and one less), under its first and its last half.
A block (m, a, b) holds words that share the first a and the last b code points; one of more
than ``BLOCK_LETTERS`` letters is taken apart by halving what lies between, which loses no
pair, until little of it is left and the alphabet bounds it. Blocks are packed by hash into
tasks' groups of about ``GROUP_LETTERS`` letters.

In a group the words are bit-sliced: for every position and code point a bitset of the words
that have it there, 64 words to a machine word. The group's words are queried against it, many at
once: at each letter of the query one set of words without an error and three with one error
(replaced: same position; inserted in the word: one position on; left out of the word: one
position back) go on by ANDs with the bitsets of their positions. Only three positions
are held at a time, so memory is bounded by the letters of the group, not by its longest word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
BLOCK_LETTERS, GROUP_LETTERS = 200_000, 40_000
QUERIES = 256  # queried at once


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspelt: int | None = None,
               least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts, [A-Z] lower-cased, of at least ``least_letters`` code
    points, and how often they occur, from ``least_count``. With ``misspelt``, a run loses a code
    point where the crc32 of ``<id>:<run>`` is divisible by it. A null id counts as an empty one."""
    run = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.expr(
        f"regexp_extract_all({'`' + text_col + '`'}, '[A-Za-z\\\\u00C0-\\\\u00FF]+', 0)")).alias("run"))
    lower = run.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    if misspelt:
        lower = lower.select("run", F.expr("crc32(concat(coalesce(id, ''), ':', run))").alias("h"))
        lower = lower.select(F.expr(
            f"IF(h % {misspelt} = 0, concat(substr(run, 1, cast(h % length(run) AS INT)), "
            "substr(run, cast(h % length(run) AS INT) + 2)), run)").alias("run"))
    return (lower.where(F.length("run") >= least_letters).groupBy(F.col("run").alias("word"))
            .agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


class Slices:
    """The bit-sliced position index of some words, as rows of code points."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) for w in words])
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]]
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet, self.letters = np.unique(letters, return_inverse=True)
        self.width = -(-len(words) // 64)
        self.bit = np.left_shift(np.uint64(1), (np.arange(len(words)) % 64).astype(np.uint64))

    def of(self, members: np.ndarray) -> np.ndarray:
        """The bitset of the words numbered ``members``."""
        out = np.zeros(self.width, np.uint64)
        np.bitwise_or.at(out, members // 64, self.bit[members])
        return out

    def at(self, position: int) -> np.ndarray:
        """Bitsets by code point of the words that have it at ``position``."""
        out = np.zeros((len(self.alphabet), self.width), np.uint64)
        if position >= 0:
            member = np.flatnonzero(self.lengths > position)
            np.bitwise_or.at(out, (self.letters[self.starts[member] + position], member // 64), self.bit[member])
        return out

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) one edit apart; ``queries`` are numbers of words of one length."""
        m = int(self.lengths[queries[0]])
        ends = {d: self.of(np.flatnonzero(self.lengths == m + d)) for d in (-1, 0, 1)}
        none = np.zeros((len(queries), self.width), np.uint64)
        exact, replaced, inserted, left_out = none | ~np.uint64(0), none, none, none
        before, here, after = self.at(-1), self.at(0), self.at(1)
        for j in range(m):
            letter = self.letters[self.starts[queries] + j]
            same = here[letter]
            left_out = (left_out & before[letter]) | exact
            replaced = (replaced & same) | (exact & ~same)
            inserted = (inserted | exact) & after[letter]
            exact = exact & same
            before, here, after = here, after, self.at(j + 2)
        found = (replaced & ends[0]) | (left_out & ends[-1]) | ((inserted | exact) & ends[1])
        query, word = np.nonzero(found)
        bits = np.unpackbits(found[query, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(bits)
        return queries[query[at]], word[at] * 64 + bit


def _pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    index, a, b = Slices(words), [], []
    order = np.argsort(index.lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(index.lengths[order])) + 1):
        step = max(1, min(QUERIES, (1 << 20) // index.width))
        for i in range(0, len(part), step):
            x, y = index.near(part[i:i + step])
            a.append(x)
            b.append(y)
    return np.concatenate(a), np.concatenate(b)


def near_pairs(words: DataFrame, block_letters: int = BLOCK_LETTERS, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """(word, other, n): every pair of near words in both orders, n that of the other.
    ``words`` (word, n) has each word once, of two code points at least."""
    common.importable(words.sparkSession)
    block = words.select("word", "n", F.explode(F.expr("array(length(word), length(word) - 1)")).alias("m"))
    block = block.select("word", "n", "m", F.lit(0).alias("a"), F.lit(0).alias("b"))
    halves = block.where("m >= 1")
    calm = None
    while True:
        # What lies between the shared ends, c code points of the shorter word, in two halves.
        halves = halves.withColumn("c", F.expr("m - a - b")).select(
            "word", "n", "m", F.explode(F.expr(
                "array(struct(a + (c + 1) div 2 AS a, b AS b), struct(a AS a, b + c div 2 AS b))")).alias("e"))
        keyed = halves.select("word", "n", "m", F.col("e.a").cast("int").alias("a"), F.col("e.b").cast("int").alias("b"))
        keyed = common.settle(keyed.withColumn(
            "key", F.expr("xxhash64(m, a, b, left(word, a), right(word, b))")).distinct(), "spelling-blocks")
        size = keyed.groupBy("key").agg(F.sum(F.length("word")).alias("letters"), F.first("m").alias("m"), F.first("a").alias("a"), F.first("b").alias("b"))
        crowded = common.settle(size.where(f"letters > {block_letters} AND m - a - b > 1").select("key"), "spelling-crowded")
        n_crowded = crowded.count()
        rest = keyed if not n_crowded else common.join_counted(keyed, crowded, "key", "left_anti", n_crowded)
        rest = rest.select("key", "m", "word", "n")
        calm = rest if calm is None else calm.union(rest)
        if not n_crowded:
            break
        halves = common.join_counted(keyed, crowded, "key", "left_semi", n_crowded).select("word", "n", "m", "a", "b")
    letters = calm.agg(F.sum(F.length("word"))).first()[0] or 0
    groups = max(1, letters // group_letters)

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("word")
        word, n = pdf["word"].to_numpy(), pdf["n"].to_numpy()
        a, b = _pairs(list(word))
        return pd.DataFrame({"word": word[a], "other": word[b], "n": n[b]})

    # Words of like lengths meet, so that a group with a very long word has few others.
    grouped = calm.withColumn("g", F.expr(f"struct(cast(log2(m) AS INT), pmod(key, {groups}))")).select("g", "word", "n")
    return grouped.groupBy("g").applyInPandas(find, "word string, other string, n long").distinct()


def variants(words: DataFrame, times: int = TIMES, **sizes: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n).

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if that is at
    least ``times`` the word's own n, else null; ``root`` is where the forms lead to, the word
    itself if it has none. An empty table gives an empty result.
    """
    words = common.settle(words.select("word", "n"), "spelling-words")
    best = common.settle(
        near_pairs(words, **sizes).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("neg"), "other")).alias("best")),
        "spelling-near")
    row = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr(f"IF(-best.neg >= {times} * n, best.other, NULL)").alias("form"),
        F.expr(f"IF(-best.neg >= {times} * n, -best.neg, NULL)").alias("form_n"))
    row = common.settle(row, "spelling-forms")
    # Every step of a chain is `times` larger, so doubling the steps ends after a few rounds.
    chain = common.settle(row.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-chains")
    while True:
        step = chain.join(chain.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        after = common.settle(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-chains")
        chain = after.select("word", "root")
        if not after.where("moved").limit(1).count():
            break
    return row.join(chain, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variants(vocabulary(docs, misspelt=199))


def _oracle() -> str:
    table = ("(SELECT list(v ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(i, range(8)), "
             "lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)))")
    return f"""
WITH crc AS MATERIALIZED (SELECT {table} AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS raw FROM documents),
lowered AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r AS s, r FROM (
  SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM runs)),
hashed AS (SELECT r, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
    range(CAST(octet_length(encode(s)) AS BIGINT)),
    lambda i: CAST(('0x' || substr(hex(encode(s)), 2 * i + 1, 2)) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) AS h FROM lowered, crc),
words AS MATERIALIZED (SELECT word, count(*) AS n FROM (
  SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
cuts AS MATERIALIZED (SELECT word, n, length(word) AS l, 0 AS i, word AS k FROM words
  UNION ALL SELECT word, n, l, i, substr(word, 1, i - 1) || substr(word, i + 1) FROM (
    SELECT word, n, length(word) AS l, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.k = b.k AND a.i > 0 AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN cuts b ON a.k = b.k AND a.i > 0 AND b.i = 0
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN cuts b ON a.k = b.k AND a.i = 0 AND b.i > 0),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
  CASE WHEN b.m >= 5 * w.n THEN b.other END AS form, CASE WHEN b.m >= 5 * w.n THEN b.m END AS form_n FROM words w LEFT JOIN best b USING (word)),
chain(word, node, form) AS (SELECT word, word, form FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.form)
SELECT f.word, f.form, c.node AS root, CAST(f.n AS BIGINT) AS n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.form IS NULL"""


ORACLE = _oracle().replace("WITH crc", "WITH RECURSIVE crc", 1)
