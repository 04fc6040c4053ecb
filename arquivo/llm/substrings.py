"""Removal of repeated word sequences by compaction of a De Bruijn graph.

An edge is a k-mer, k consecutive words of a document; its nodes are its first and last k - 1
words. Edges that occur once are not needed, and are left out without a shuffle of all:

1. A document is cut where it is read into pieces, the runs of windows that have the same
   minimizer (the smallest hash of their ``SEED``-word sequences, leftmost). Equal windows
   have equal minimizers, so only pieces whose minimizer occurs twice go on. Equal pieces are one
   edge of the graph, with the coordinates (document, start) of the first as its source.
2. Where a minimizer has several pieces (a passage begins or ends in them) their windows are the
   edges, and each has the first of its coordinates as source. No k-mer is in two edges then.
3. In- and out-degrees of the nodes are counted and joined to the edges. An edge goes on the
   path of the one before if the node between them does not branch and their sources follow each
   other, so a path is a repeated passage of one source.
4. Pieces are joined with the paths of their edges, and what a document holds of one path at
   one shift is one span: (document, start, length) and its source coordinates.
5. The text of both coordinates of every span is read and digested; spans whose digests differ
   (hashes that collided) are not repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arquivo.llm import common

K, SEED = 20, 8
#: A document's requests for text are split into lists of about this many.
REQUESTS = 10_000
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 2**64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any word sequences of one text, as differences of a prefix sum."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        self.power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, _ODD, np.uint64)])
        back = np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(0, n - 1), _INVERSE, np.uint64)])
        self.sums = np.r_[np.uint64(0), np.cumsum(word * back[:n])]

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * self.power[start] + np.uint64(length))

    def every(self, length: int) -> np.ndarray:
        return self.of(np.arange(len(self.sums) - length), length)


def pieces(words: list[bytes], k: int = K, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """(minimizer, hash, start, windows) of the runs of windows with the same minimizer."""
    if len(words) < k:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    hashes = Hashes(words)
    gram = hashes.every(seed)
    # The upper half decides, the position breaks ties.
    low = (gram >> np.uint64(32) << np.uint64(32)) | np.arange(len(gram)).astype(np.uint64)
    wide, width = 1, k - seed + 1
    while wide < width:
        step = min(wide, width - wide)
        low = np.minimum(low[:-step], low[step:])
        wide += step
    at = (low & np.uint64(2**32 - 1)).astype(np.int64)
    start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[start, len(at)])
    return gram[at[start]], hashes.of(start, count + k - 1), start, count


def _batches(columns: list[tuple[str, pa.DataType]], rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of some 100,000 rows from tuples of equally long arrays."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0])
        if size >= 100_000:
            yield _batch(columns, held)
            held, size = [], 0
    if held:
        yield _batch(columns, held)


def _batch(columns: list[tuple[str, pa.DataType]], held: list[tuple]) -> pa.RecordBatch:
    arrays = []
    for i, (_, kind) in enumerate(columns):
        parts = [row[i] for row in held]
        if isinstance(parts[0], np.ndarray):
            whole = np.concatenate(parts)
            arrays.append(pa.array(whole.view(np.int64) if whole.dtype == np.uint64 else whole, kind))
        else:
            arrays.append(pa.array([x for p in parts for x in p], kind))
    return pa.RecordBatch.from_arrays(arrays, names=[c for c, _ in columns])


def _cut(rows: DataFrame, k: int) -> DataFrame:
    """(id, rid, mini, hash, at, n): the pieces of all texts."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("id").type

            def cut():
                for id, rid, text in zip(batch.column("id").to_pylist(), batch.column("rid").to_pylist(), batch.column("text")):
                    mini, hash, at, n = pieces(_words(text.as_py()), k, max(1, min(SEED, k // 2)))
                    if len(at):
                        yield [id] * len(at), np.full(len(at), rid, np.int64), mini, hash, at.astype(np.int32), n.astype(np.int32)

            yield from _batches([("id", kind), ("rid", pa.int64()), ("mini", pa.int64()), ("hash", pa.int64()),
                                 ("at", pa.int32()), ("n", pa.int32())], cut())

    return rows.select("id", "rid", "text").mapInArrow(of, f"{_id(rows)}, rid long, mini long, hash long, at int, n int")


def _id(rows: DataFrame) -> str:
    return f"id {rows.schema['id'].dataType.simpleString()}"


def _asked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, rid, text, asked): the texts of the documents for which ``wanted`` (id, rid, ask) has
    rows, each with a list of its asks; a document with many comes several times."""
    many = (wanted.groupBy("id", "rid").agg(F.count("*").alias("asks")).where(F.col("asks") > REQUESTS)
            .select(F.col("id").alias("mid"), F.col("rid").alias("mrid"), "asks"))
    salted = wanted.join(many, F.expr("rid = mrid AND id <=> mid"), "left").select(
        "id", "rid", "ask", F.expr(f"coalesce(pmod(xxhash64(ask), asks div {REQUESTS} + 1), 0)").alias("salt"))
    lists = salted.groupBy("id", "rid", "salt").agg(F.collect_list("ask").alias("asked"))
    lists = lists.select(F.col("id").alias("aid"), F.col("rid").alias("arid"), "asked")
    return rows.join(lists, F.expr("rid = arid AND id <=> aid")).select("id", "rid", "text", "asked")


def _edges(rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(mini, hash, copies, id, rid, at, j, n, edge, u, v) of the asked pieces (mini, hash, at, n, whole, copies):
    a whole piece is one edge, of another every window j is one; u and v are hashes of its nodes."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("id").type

            def cut():
                for id, rid, text, asked in zip(*(batch.column(c) for c in ("id", "rid", "text", "asked"))):
                    hashes, asked = Hashes(_words(text.as_py())), asked.as_py()
                    n = np.array([a["n"] for a in asked])
                    whole = np.array([a["whole"] for a in asked])
                    rows = np.where(whole, 1, n)
                    of = np.repeat(np.arange(len(asked)), rows)
                    j = np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
                    length = np.where(whole, n, 1)[of]
                    at = np.array([a["at"] for a in asked])[of] + j
                    mini, hash, copies = (np.array([a[c] for a in asked], np.int64)[of] for c in ("mini", "hash", "copies"))
                    yield (mini, hash, copies, [id.as_py()] * len(of), np.full(len(of), rid.as_py(), np.int64), at.astype(np.int32), j.astype(np.int32),
                           length.astype(np.int32), hashes.of(at, length + k - 1), hashes.of(at, k - 1), hashes.of(at + length, k - 1))

            yield from _batches([("mini", pa.int64()), ("hash", pa.int64()), ("copies", pa.int64()), ("id", kind), ("rid", pa.int64()), ("at", pa.int32()), ("j", pa.int32()),
                                 ("n", pa.int32()), ("edge", pa.int64()), ("u", pa.int64()), ("v", pa.int64())], cut())

    texts = _asked(rows, wanted)
    return texts.mapInArrow(of, f"mini long, hash long, copies long, {_id(rows)}, rid long, at int, j int, n int, edge long, u long, v long")


def _digests(rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(id, rid, at, n, digest) of the asked spans (at, n), by their texts."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("id").type

            def read():
                for id, rid, text, asked in zip(*(batch.column(c) for c in ("id", "rid", "text", "asked"))):
                    words, asked = _words(text.as_py()), asked.as_py()
                    digest = [hashlib.blake2b(b" ".join(words[a["at"]:a["at"] + a["n"] + k - 1]), digest_size=16).digest() for a in asked]
                    yield ([id.as_py()] * len(asked), np.full(len(asked), rid.as_py(), np.int64), np.array([a["at"] for a in asked], np.int32),
                           np.array([a["n"] for a in asked], np.int32), digest)

            yield from _batches([("id", kind), ("rid", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("digest", pa.binary())], read())

    return _asked(rows, wanted).mapInArrow(of, f"{_id(rows)}, rid long, at int, n int, digest binary")


def _paths(edges: DataFrame) -> DataFrame:
    """Adds ``start``, where the source of an edge's compacted path begins, to the distinct
    repeated edges (mini, edge, n, u, v, source of id, rid, at)."""
    node = edges.select(F.explode(F.expr("array(struct(u AS node, 1 AS o, 0 AS i), struct(v AS node, 0 AS o, 1 AS i))")).alias("e")).select("e.*")
    plain = node.groupBy("node").agg(F.sum("o").alias("o"), F.sum("i").alias("i")).where("o = 1 AND i = 1").select(F.col("node").alias("u"), F.lit(True).alias("plain"))
    known = edges.join(plain, "u", "left")
    line = Window.partitionBy("source.id", "source.rid").orderBy("source.at")  # at most a document's edges
    goes_on = F.col("plain") & (F.lag(F.col("source.at") + F.col("n")).over(line) == F.col("source.at"))
    begins = known.withColumn("begins", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("source.at")))
    return begins.withColumn("start", F.last("begins", ignorenulls=True).over(line)).drop("begins", "plain")


def repeated_spans(rows: DataFrame, k: int = K) -> DataFrame:
    """(id, rid, at, n, source): n windows from word ``at`` of a document whose texts also start
    earlier, at ``source`` (id, rid, at): a smaller id, or the same document further left.
    ``rows``: (id, rid, text), rid telling rows of one id apart."""
    every = common.settle(_cut(rows, k), "substring-pieces")
    shared = common.settle(every.groupBy("mini").agg(F.count("*").alias("c")).where("c > 1").select("mini"), "substring-shared")
    piece = common.settle(
        common.join_counted(every, shared, "mini", "left_semi", shared.count()).select("id", "rid", "mini", "hash", "at", "n"), "substring-repeated")
    common.free(every, shared)

    kind = common.settle(piece.groupBy("mini", "hash").agg(
        F.max("n").alias("n"), F.count("*").alias("copies"), F.min(F.struct("id", "rid", "at")).alias("source")), "substring-kinds")
    single = kind.groupBy("mini").agg(F.count("*").alias("kinds")).where("kinds = 1").select("mini", F.lit(True).alias("whole"))
    kind = kind.join(single, "mini", "left").withColumn("whole", F.coalesce("whole", F.lit(False)))
    kind = common.settle(kind.where("copies > 1 OR NOT whole"), "substring-edges-of")
    wanted = kind.select("source.id", "source.rid", F.struct("mini", "hash", "source.at", "n", "whole", "copies").alias("ask"))
    cut = common.settle(_edges(rows, wanted, k), "substring-edges")
    edge = cut.groupBy("mini", "edge").agg(
        F.max("n").alias("n"), F.max("u").alias("u"), F.max("v").alias("v"), F.sum("copies").alias("copies"),
        F.min(F.struct("id", "rid", "at")).alias("source")).where("copies > 1").drop("copies")
    path = common.settle(_paths(common.settle(edge, "substring-distinct")).select("mini", "edge", "source", "start"), "substring-paths")

    # What a piece has of a path, then what a document has of it at one shift.
    part = (cut.select("mini", "hash", "j", "n", "edge").join(path, ["mini", "edge"])
            .groupBy("mini", "hash", F.col("source.id").alias("sid"), F.col("source.rid").alias("srid"), "start", F.expr("source.at - j").alias("shift"))
            .agg(F.min("j").alias("j"), F.expr("max(j + n) - min(j)").alias("m")))  # without gaps: they would show as edges
    part = common.settle(part, "substring-parts")
    held = (piece.select("id", "rid", "mini", "hash", "at").join(part, ["mini", "hash"])
            .select("id", "rid", "sid", "srid", "start", F.expr("shift - at").alias("shift"), F.expr("at + j").alias("at"), F.col("m").alias("n"))
            .where("NOT (shift = 0 AND rid = srid AND id <=> sid)"))
    merged = ("aggregate(array_sort(collect_set(struct(at, n))), cast(array() AS array<struct<at:int,n:int>>), (s, x) -> "
              "IF(size(s) > 0 AND s[size(s) - 1].at + s[size(s) - 1].n >= x.at, concat(slice(s, 1, size(s) - 1), "
              "array(struct(s[size(s) - 1].at AS at, greatest(s[size(s) - 1].n, x.at + x.n - s[size(s) - 1].at) AS n))), concat(s, array(x))))")
    span = (held.groupBy("id", "rid", "sid", "srid", "start", "shift").agg(F.expr(merged).alias("spans"))
            .select("id", "rid", "sid", "srid", "shift", F.explode("spans").alias("span"))
            .select("id", "rid", F.col("span.at").alias("at"), F.col("span.n").alias("n"), "sid", "srid", F.expr("span.at + shift").alias("sat")))
    span = common.settle(span, "substring-spans")
    common.free(piece, kind, cut, path, part)

    ask = F.struct("at", "n").alias("ask")
    both = span.select("id", "rid", ask).union(span.select("sid", "srid", F.struct(F.col("sat").alias("at"), "n").alias("ask"))).distinct()
    digest = common.settle(_digests(rows, both, k), "substring-digests").distinct()
    own = span.join(digest.select(*(F.col(c).alias(f"o{c}") for c in ("id", "rid", "at", "n")), F.col("digest").alias("own")),
                    F.expr("rid = orid AND at = oat AND n = on AND id <=> oid"))
    same = own.join(digest.select(*(F.col(c).alias(f"s_{c}") for c in ("id", "rid", "at", "n", "digest"))),
                    F.expr("srid = s_rid AND sat = s_at AND n = s_n AND sid <=> s_id AND own = s_digest"))
    return common.settle(same.select("id", "rid", "at", "n", F.struct(
        F.col("sid").alias("id"), F.col("srid").alias("rid"), F.col("sat").alias("at")).alias("source")), "substring-verified")


def _kept(rows: DataFrame, spans: DataFrame, k: int) -> DataFrame:
    """(id, n_words, n_removed, kept) of every row."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                words = _words(text.as_py())
                n = len(words)
                if spans := spans.as_py():
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, [s["at"] for s in spans], 1)
                    np.add.at(edge, [s["at"] + s["n"] + k - 1 for s in spans], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0)]
                total.append(n)
                removed.append(n - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=["id", "n_words", "n_removed", "kept"])

    # A document's spans are at most as many as its windows and their sources; each start once, at its longest.
    lists = (spans.groupBy(F.col("id").alias("sid"), F.col("rid").alias("srid"), "at").agg(F.max("n").alias("n"))
             .groupBy("sid", "srid").agg(F.collect_list(F.struct("at", "n")).alias("spans")))
    whole = rows.join(lists, F.expr("rid = srid AND id <=> sid"), "left").select("id", "text", "spans")
    return whole.mapInArrow(of, f"{_id(rows)}, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(id, n_words, n_removed, kept) of every row: its words, those covered by a window of
    ``k`` words that also starts earlier, and the others joined by single blanks.

    Earlier is a smaller id, or the same document further left; null ids come first, and of
    different texts with one id that with the smaller hash. Rows repeated with id and text
    are one document and are all decided alike. Null texts have no words; texts of fewer than
    ``k`` words keep all. Other columns are ignored, whatever their names. An empty table
    gives an empty result.
    """
    common.importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("rid"), F.col(text_col).alias("text"))
    return _kept(rows, repeated_spans(rows, k), k)


def op12_substrings(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    out = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH split AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, list_aggregate(w[i + 1 : i + 20], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS i FROM split WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
covered AS (SELECT DISTINCT doc_id, i + unnest(range(20)) AS i FROM later),
gone AS (SELECT doc_id, list(i) AS g FROM covered GROUP BY doc_id),
kept AS (SELECT doc_id, len(w) AS n, CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(g, i - 1)) END AS k
  FROM split LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(k) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept"""
