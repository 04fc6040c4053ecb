"""SimHash near-duplicates by a binary trie self-join.

A fingerprint is the bitwise majority of the 64-bit hashes of a document's word shingles
(repeats count). Distinct fingerprints form a binary trie; the self-join walks pairs of its
nodes together, counts the bits in which the two paths differ and drops a pair as soon as
its error budget is exceeded.

Budget: two fingerprints that differ in at most ``max_bits`` bits differ in at most
``max_bits // 2`` bits of one of their halves. So the trie is walked twice, once with either
half first, with that smaller budget while in the first half and the full one below it.
The two walks together lose no pair.

On Spark the upper trie levels are keys: a fingerprint goes to its own node and to every
larger node within the budget, and a task walks the rest of the trie under one node. A
node with more than ``node_rows`` members is taken apart into its children before that,
again and again, so a node that holds a third of all fingerprints is many tasks. A task
gives a spanning forest of its links, not the pairs of a group; components of the union
are those of all links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common

FIRST = 32  # bits of the first half
STEP = 4  # levels by which a crowded node is taken apart


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text, as a signed number; no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII spaces
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    ones, n = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, 42) for g in grams], dtype=">u8")
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):  # bounded memory for very long texts
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, shingle: int, out: str) -> DataFrame:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(out, of(F.col(text_col)))


def _half(max_bits: int) -> int:
    return max_bits // 2


def _links(values: np.ndarray, home: int, depth: int, max_bits: int, seed: int = 1 << 16) -> np.ndarray:
    """Walk the trie under one node. ``values``: sorted unsigned numbers, of which those
    from index ``home`` on lie under the node and the earlier ones visit it from smaller
    nodes. Returns for each value the index of its component's smallest value."""
    n = len(values)
    label = np.arange(n)
    if n - home < 1 or n < 2:
        return label
    # groups of visitors: each is a node of the trie at this depth
    shift = np.uint64(64 - depth)
    tops = values[:home] >> shift if depth else np.zeros(home, np.uint64)
    starts = np.flatnonzero(np.r_[True, tops[1:] != tops[:-1]]) if home else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], home] if home else starts
    here = values[home] >> shift if depth else np.uint64(0)
    diff = np.bitwise_count(tops[starts] ^ here).astype(np.int64) if home else starts
    frontier = [(depth, np.r_[starts, home], np.r_[ends, n], np.r_[np.full(len(starts), home), home],
                 np.r_[np.full(len(starts), n), n], np.r_[diff, 0])]

    def link(a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                return
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up

    ones: dict[int, np.ndarray] = {}
    while frontier:
        d, lo1, hi1, lo2, hi2, err = frontier.pop()
        if len(lo1) > seed:  # depth first in pieces, so that memory stays bounded
            for i in range(0, len(lo1), seed):
                frontier.append((d, *(x[i : i + seed] for x in (lo1, hi1, lo2, hi2, err))))
            continue
        size = (hi1 - lo1) * (hi2 - lo2)
        leaf = (size <= 64) | (d == 64)
        if leaf.any():
            l1, h1, l2, h2 = lo1[leaf], hi1[leaf], lo2[leaf], hi2[leaf]
            count = size[leaf]
            for i in range(0, len(count), 8192):
                c = count[i : i + 8192]
                pair = np.repeat(np.arange(i, i + len(c)), c)
                at = np.arange(len(pair)) - np.repeat(np.cumsum(c) - c, c)
                width = (h2 - l2)[pair]
                a, b = l1[pair] + at // width, l2[pair] + at % width
                near = (a < b) & (np.bitwise_count(values[a] ^ values[b]) <= max_bits)
                link(a[near], b[near])
        if leaf.all():
            continue
        lo1, hi1, lo2, hi2, err = (x[~leaf] for x in (lo1, hi1, lo2, hi2, err))
        if d not in ones:
            ones[d] = np.r_[0, np.cumsum((values >> np.uint64(63 - d)) & np.uint64(1))].astype(np.int64)
        one = ones[d]
        m1, m2 = hi1 - (one[hi1] - one[lo1]), hi2 - (one[hi2] - one[lo2])
        same = lo1 == lo2
        crossed = ~same
        budget = _half(max_bits) if d + 1 <= FIRST else max_bits
        child = [
            (lo1, m1, lo2, m2, err, np.ones(len(lo1), bool)),
            (m1, hi1, m2, hi2, err, np.ones(len(lo1), bool)),
            (lo1, m1, m2, hi2, err + 1, np.ones(len(lo1), bool)),
            (m1, hi1, lo2, m2, err + 1, crossed),
        ]
        parts = []
        for a, b, c, e, x, use in child:
            keep = use & (a < b) & (c < e) & (x <= budget)
            parts.append(tuple(v[keep] for v in (a, b, c, e, x)))
        frontier.append((d + 1, *(np.concatenate(v) for v in zip(*parts))))
    return label


def _turned(x: str) -> str:
    return f"(shiftleft({x}, 32) | shiftrightunsigned({x}, 32))"


def links(prints: DataFrame, max_bits: int = 3, node_rows: int = 16384) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``fp``) whose components are
    those of all pairs within ``max_bits``. ``prints`` has each fingerprint once."""
    rows = prints.count()
    # A node also holds visitors, about half as many times its own as it has levels above.
    depth = common.bits_for(rows, max(1, node_rows // 16), 2, FIRST - STEP)
    half = _half(max_bits)
    both = prints.select(F.explode(F.expr(f"array(struct(0 AS turn, fp AS x), struct(1 AS turn, {_turned('fp')} AS x))")).alias("s")).select("s.*")
    top = f"shiftrightunsigned(x, {64 - depth})"
    near = f"array({top})"
    for flips in range(1, half + 1):  # larger nodes in which at most `half` bits differ
        near = (f"array_distinct(flatten(transform({near}, p -> concat(array(p), transform("
                f"sequence(0, {depth - 1}), i -> p ^ shiftleft(1L, i))))))")
    item = both.select("turn", "x", F.explode(F.expr(
        f"filter({near}, p -> p >= {top} AND bit_count(p ^ {top}) <= {half})")).alias("node"))
    found = None
    while True:
        if depth < 64:
            size = item.groupBy("turn", "node").agg(F.count("*").alias("n"))
            crowded = common.settle(size.where(F.col("n") > node_rows), "simhash-crowded")
            n_crowded = crowded.count()
        else:
            n_crowded = 0
        calm = item
        if n_crowded:
            item = common.settle(item, "simhash-items")
            calm = common.join_counted(item, crowded.select("turn", "node"), ["turn", "node"], "left_anti", n_crowded)
        part = _walk(calm, depth, max_bits)
        if not n_crowded:
            return part if found is None else found.union(part)
        part = common.settle(part, "simhash-links")
        found = part if found is None else found.union(part)
        down = min(64, depth + STEP)
        budget = half if down <= FIRST else max_bits
        k = down - depth
        top = f"shiftrightunsigned(x, {64 - down})" if down < 64 else "x"
        # A prefix of all 64 bits compares as unsigned once its sign bit is flipped.
        order = "p >= t" if down < 64 else "(p ^ shiftleft(1L, 63)) >= (t ^ shiftleft(1L, 63))"
        item = (common.join_counted(item, crowded.select("turn", "node"), ["turn", "node"], "left_semi", n_crowded)
                .select("turn", "x", "node", F.expr(top).alias("t"))
                .select("turn", "x", F.explode(F.expr(
                    f"filter(transform(sequence(0, {2**k - 1}), c -> shiftleft(node, {k}) | cast(c AS BIGINT)), "
                    f"p -> {order} AND bit_count(p ^ t) <= {budget})")).alias("node")))
        depth = down


def _walk(item: DataFrame, depth: int, max_bits: int) -> DataFrame:
    def under(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        turn, node = int(key[0]), int(key[1])
        x = np.sort(pdf["x"].to_numpy(np.int64).view(np.uint64))
        first = np.uint64((node << (64 - depth)) & (2**64 - 1))
        home = int(np.searchsorted(x, first))
        label = _links(x, home, depth, max_bits)
        far = np.flatnonzero(label != np.arange(len(x)))
        a, b = x[far], x[label[far]]
        if turn:
            a, b = ((v << np.uint64(32)) | (v >> np.uint64(32)) for v in (a, b))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return item.groupBy("turn", "node").applyInPandas(under, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 3, node_rows: int = 16384) -> DataFrame:
    """One row per input row: id, ``fp`` (signed long), ``component`` (the smallest id of
    all rows linked to it, directly or through others).

    Null texts and texts without words have fingerprint zero and are linked like any other.
    Rows with a null id are grouped too but never name a group (a group of only such rows
    has a null component). Repeated rows stay. An empty table gives an empty result. Other
    columns are ignored, whatever their names.
    """
    common.importable(docs.sparkSession)
    ids = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    row = common.settle(with_fingerprint(ids, "text", shingle, "fp").select("id", "fp"), "simhash-rows")
    node = common.settle(row.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    group = common.components(links(node.select("fp"), max_bits, node_rows), "simhash-components")
    rooted = (node.join(group.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least", F.coalesce("component", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of = rooted.join(named, "root").select("fp", "component")
    return row.join(common.settle(of, "simhash-named"), "fp", "left").select(F.col("id").alias(id_col), "fp", "component")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_groups(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def stage_simhash(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: of each group of near-duplicates the document with the
    smallest id stays (rows repeated with that id are the same document). Null and empty
    texts are one group. Rows with a null id count as one document, which stays if any of
    them is in a group without ids. An empty table stays empty. Other columns pass, whatever their names."""
    named = simhash_groups(docs).groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component"))).alias("stays"))
    gone = common.settle(named.where("NOT stays").select("doc_id"), "simhash-gone")
    return common.join_counted(docs.alias("d"), gone.alias("g"), F.expr("d.doc_id <=> g.doc_id"), "left_anti", gone.count())
