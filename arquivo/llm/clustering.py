"""Centroid clustering of integer vectors by subvector dictionaries.

Vectors are cut into blocks of ``BLOCK`` dimensions. The distinct subvectors of a block are its
dictionary, and a vector is the array of its blocks' codes, which loses nothing. The squared
distance to a centroid is a sum over blocks, so a round computes the distances of every distinct
subvector once, whatever number of vectors hold it, and a vector's distance is the sum of those
of its codes.

The distances of a round (dictionary rows x centroids, 8 bytes each) are broadcast while they
are at most ``TABLE_BYTES``: vectors of components within [-1, 1] have at most 129 ** 2 distinct
pairs a block, whatever their number. A larger dictionary is joined to the vectors' codes instead,
and the distances are summed by vector. Only centroids, their sums and that table reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common

DIMENSIONS, SCALE, BLOCK = 64, 64, 2
TABLE_BYTES = 64 << 20


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id, v): the rows with ``dimensions`` components, none null or not finite, each as
    floor(scale * x). A component whose integer is beyond 2 ** 27 raises, for its squared
    distances might not fit a long."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    # NaN is larger than any other double, so it fails the bound too.
    whole = rows.where(f"size(x) = {dimensions} AND forall(x, e -> e IS NOT NULL AND abs(e) < double('Infinity'))")
    return whole.select("id", F.expr(
        f"transform(x, e -> IF(abs(floor({scale} * e)) <= {1 << 27}, cast(floor({scale} * e) AS BIGINT), "
        "cast(raise_error('a component is too large for exact distances') AS BIGINT)))").alias("v"))


def _encoded(rows: DataFrame, dimensions: int, block: int, most: int) -> tuple[DataFrame, DataFrame, int]:
    """The dictionary (block, code, sub), the rows (id, v, codes) and the dictionary's length.
    Up to ``most`` subvectors are numbered from 1 in every block; more get any distinct codes."""
    blocks = -(-dimensions // block)
    cut = f"transform(sequence(0, {blocks - 1}), b -> slice(v, b * {block} + 1, {block}))"
    sub = common.settle(rows.select(F.posexplode(F.expr(cut)).alias("block", "sub")).distinct(), "cluster-subvectors")
    size = sub.count()
    code = F.expr("row_number() OVER (PARTITION BY block ORDER BY sub)") if size <= most else F.monotonically_increasing_id()
    dictionary = common.settle(sub.select("block", code.cast("bigint").alias("code"), "sub"), "cluster-dictionary")
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    keyed = common.settle(keyed, "cluster-rows")
    part = keyed.select("row", F.posexplode(F.expr(cut)).alias("block", "sub"))
    coded = (common.join_counted(part, dictionary, ["block", "sub"], "inner", size)
             .groupBy("row").agg(F.expr("transform(array_sort(collect_list(struct(block, code))), c -> c.code)").alias("codes")))
    return dictionary, common.settle(keyed.join(coded, "row"), "cluster-encoded"), size


def _partial(dictionary: DataFrame, centroids: list[list[int]], block: int) -> DataFrame:
    """(block, code, d): the squared distances of a subvector to the same block of every centroid."""
    starts = range(0, len(centroids[0]), block)
    parts = dictionary.sparkSession.createDataFrame(
        [(i, [c[b:b + block] for c in centroids]) for i, b in enumerate(starts)], "block int, c array<array<bigint>>")
    return dictionary.join(F.broadcast(parts), "block").select("block", "code", F.expr(
        "transform(c, x -> aggregate(zip_with(x, sub, (p, q) -> (p - q) * (p - q)), 0L, (s, e) -> s + e))").alias("d"))


def _assigned(encoded: DataFrame, dictionary: DataFrame, dense: bool, centroids: list[list[int]], block: int) -> DataFrame:
    """(id, v, cluster, distance): the nearest centroid of every row; ties: the smaller number."""
    part, k = _partial(dictionary, centroids, block), len(centroids)
    if not dense:
        code = encoded.select("row", F.posexplode("codes").alias("block", "code"))
        summed = (code.join(part, ["block", "code"]).groupBy("row")
                  .agg(F.array(*(F.sum(F.col("d")[i]) for i in range(k))).alias("d")))
        near = summed.select("row", F.expr("array_min(d)").alias("distance"), F.expr("array_position(d, array_min(d)) - 1").cast("int").alias("cluster"))
        return encoded.join(near, "row").select("id", "v", "cluster", "distance")
    table = part.toArrow()
    at = np.lexsort((table["code"].to_numpy(), table["block"].to_numpy()))
    distance = table["d"].combine_chunks().flatten().to_numpy().reshape(-1, k)[at]
    first = np.searchsorted(table["block"].to_numpy()[at], np.arange(-(-len(centroids[0]) // block)))
    shared = encoded.sparkSession.sparkContext.broadcast((distance, first))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance, first = shared.value
        for batch in batches:
            codes = batch.column("codes").flatten().to_numpy().reshape(batch.num_rows, len(first))
            total = np.zeros((batch.num_rows, distance.shape[1]), np.int64)
            for b, start in enumerate(first):
                total += distance[start + codes[:, b] - 1]
            cluster = total.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(cluster.astype(np.int32)), pa.array(total[np.arange(len(total)), cluster])],
                names=["id", "v", "cluster", "distance"])

    rows = encoded.select("id", "v", "codes")
    return rows.mapInArrow(nearest, f"id {rows.schema['id'].dataType.simpleString()}, v array<bigint>, cluster int, distance bigint")


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16, rounds: int = 3,
             dimensions: int = DIMENSIONS, scale: int = SCALE, block: int = BLOCK, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every kept vector.

    Centroids start as the ``k`` kept vectors with the smallest sha256 of ``1:<id>`` (equal ids:
    by components; null ids after all others); of fewer vectors each is one. A round assigns
    every vector to its nearest centroid (ties: the smaller number) and replaces a centroid with
    vectors by the floor of their componentwise mean; then vectors are assigned once more.

    Vectors that are null, shorter or longer, or have a null or non-finite component are not
    kept. Repeated rows are vectors of their own. No kept vector: an empty result. Other
    columns are ignored, whatever their names.
    """
    common.importable(vectors.sparkSession)
    kept = integer_vectors(vectors, id_col, vector_col, dimensions, scale)
    most = table_bytes // (8 * k)
    dictionary, encoded, size = _encoded(kept, dimensions, block, most)
    hashed = encoded.select("v", F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256).alias("h"))
    centroids = [list(r.v) for r in hashed.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()]
    schema = f"id {encoded.schema['id'].dataType.simpleString()}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], schema)

    def assigned() -> DataFrame:
        return _assigned(encoded, dictionary, size <= most, centroids, block)

    for _ in range(rounds):
        sums = (assigned().select("cluster", F.posexplode("v").alias("i", "x")).groupBy("cluster", "i")
                .agg(F.count("*").alias("n"), F.sum("x").alias("s")))
        for r in sums.collect():  # k x dimensions rows
            centroids[r["cluster"]][r["i"]] = r["s"] // r["n"]
    last = common.settle(assigned().drop("v"), "cluster-assigned")
    inertia = {r["cluster"]: r["s"] for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    named = vectors.sparkSession.createDataFrame(
        [(c, s, sum(inertia.values()), centroids[c]) for c, s in inertia.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return last.join(F.broadcast(named), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def op13_centroids(spark, sf_dir: str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    out = clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def _oracle(k: int = 16, rounds: int = 3) -> str:
    def assign(i: int) -> str:
        return (f"d{i} AS (SELECT v.vec_id, c.cluster, CAST(sum((v.e - c.e) * (v.e - c.e)) AS BIGINT) AS distance "
                f"FROM v JOIN c{i} c USING (i) GROUP BY ALL), "
                f"a{i} AS (SELECT vec_id, CAST(arg_min(cluster, (distance, cluster)) AS INTEGER) AS cluster, min(distance) AS distance FROM d{i} GROUP BY vec_id)")

    steps = []
    for i in range(rounds):
        steps.append(assign(i))
        steps.append(f"c{i + 1} AS (SELECT c.cluster, c.i, CASE WHEN m.n IS NULL THEN c.e ELSE m.e END AS e FROM c{i} c LEFT JOIN ("
                     "SELECT cluster, i, count(*) AS n, "
                     "CAST((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS e "
                     f"FROM a{i} JOIN v USING (vec_id) GROUP BY cluster, i) m USING (cluster, i))")
    return (
        f"WITH w AS (SELECT vec_id, embedding AS x FROM embeddings WHERE len(embedding) = {DIMENSIONS} "
        "AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64), "
        f"v AS MATERIALIZED (SELECT vec_id, unnest(range({DIMENSIONS})) AS i, CAST(floor({SCALE} * CAST(unnest(x) AS DOUBLE)) AS BIGINT) AS e FROM w), "
        f"s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM w QUALIFY cluster < {k}), "
        "c0 AS (SELECT cluster, i, e FROM s JOIN v USING (vec_id)), "
        + ", ".join(steps) + ", " + assign(rounds)
        + f", h AS (SELECT cluster, sha256(string_agg(CAST(e AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) "
        "SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{rounds} JOIN h USING (cluster)")


ORACLE = _oracle()
