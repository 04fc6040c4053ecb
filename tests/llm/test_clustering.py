"""Centroid clustering against a plain loop over all vectors and centroids."""

import hashlib
import math
import random

import pytest

from arquivo.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, block string, code int, row int"


def plain(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]

    def order(x):
        return (x[0] is None, hashlib.sha256(f"1:{x[0]}".encode()).hexdigest() if x[0] is not None else "", x[1])

    centroids = [v for _, v in sorted(kept, key=order)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            if own := [v for (_, v), (_, c) in zip(kept, near) if c == j]:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    sums = {}
    for d, j in near:
        sums[j] = sums.get(j, 0) + d
    return sorted(((i, j, d, sums[j], sum(sums.values()), centroids[j]) for (i, _), (d, j) in zip(kept, near)), key=str)


def cases():
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(60)]
    rows += [(i, [0.5] * 64) for i in range(60, 100)]  # ties, and a third of all rows equal
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, [0.25] * 64), (None, None)]
    rows += [(200, None), (201, []), (202, [0.0] * 63), (203, [0.0] * 65), (204, [None] + [0.0] * 63),
             (205, [float("nan")] + [0.0] * 63), (206, [float("inf")] + [0.0] * 63), (207, [-1e-9] * 64)]
    return rows


@pytest.mark.parametrize("table_bytes", [clustering.TABLE_BYTES, 0])
@pytest.mark.parametrize("block", [2, 5])
def test_equals_plain_loop(spark, table_bytes, block):
    import numpy as np

    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in cases()]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA)
    out = clustering.clusters(df, table_bytes=table_bytes, block=block).collect()
    assert sorted(((r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in out), key=str) == plain(rows)


def test_dictionary_is_lossless(spark):
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in cases()], SCHEMA)
    dictionary, encoded, size = clustering._encoded(clustering.integer_vectors(df, "vec_id", "embedding"), 64, 2, 10**6)
    sub = {(r.block, r.code): list(r["sub"]) for r in dictionary.collect()}
    assert len(sub) == size
    for r in encoded.collect():
        assert [x for b, c in enumerate(r.codes) for x in sub[b, c]] == list(r.v)


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(1, [1.0] * 64, "", 0, 0), (2, [2.0] * 64, "", 0, 0)], SCHEMA)
    assert sorted((r.id, r.distance) for r in clustering.clusters(few).collect()) == [(1, 0), (2, 0)]
    none = clustering.clusters(few.where("vec_id > 5"))
    assert none.columns == clustering.clusters(few).columns and none.collect() == []


def test_too_large_components_raise(spark):
    df = spark.createDataFrame([(1, [1e30] + [0.0] * 63, "", 0, 0)], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        clustering.clusters(df).collect()
