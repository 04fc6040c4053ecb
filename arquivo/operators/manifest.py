"""Checksum manifests and transfer statistics.

A manifest row holds the sha256 and byte size of a stored file next to the
catalog facts of the remote file it came from. Contents are hashed where they
are read (``sha2`` on the binary column), per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEGA = 1_000_000


def hash_contents(binary: DataFrame, content_col: str = "content") -> DataFrame:
    """sha256 (hex) and size in bytes of each binary content; drops the content."""
    return binary.withColumn("sha256", F.sha2(F.col(content_col), 256)).withColumn(
        "size_bytes", F.length(F.col(content_col)).cast("bigint")
    ).drop(content_col)


def manifest(hashed: DataFrame, entries: DataFrame, path_col: str = "path",
             base_url: str = "", entry_key: str = "local_path") -> DataFrame:
    """K3 + J5: join hashed stored files to their catalog entries, by stored
    path by default (``path_col`` = ``entry_key``).

    Output: url, size, filepath, suffix, dataset, created_at, sha256,
    size_bytes, partition, preliminary, remote_datetime (ISO text), and the
    nested ``metadata`` struct of the manifest record. A stored file without an entry
    stays, with null catalog fields."""
    e = entries.select(
        F.col(entry_key).alias("_ek"), F.col("local_path").alias("_lp"), "url", "size", "extension",
        "dataset", "datetime", "partition", "preliminary",
    )
    h = hashed.select(F.col(path_col).alias("_hk"), "sha256", "size_bytes")
    j = h.join(e, F.col("_hk") == F.col("_ek"), "left")
    iso = F.date_format(F.col("datetime"), "yyyy-MM-dd'T'HH:mm:ss")
    return j.select(
        F.concat(F.lit(base_url), F.col("url")).alias("url"),
        "size",
        F.coalesce("_lp", F.col("_hk").cast("string")).alias("filepath"),
        F.col("extension").alias("suffix"),
        "dataset",
        F.col("datetime").alias("created_at"),
        "sha256",
        "size_bytes",
        "partition",
        "preliminary",
        iso.alias("remote_datetime"),
        F.struct(
            "sha256", "size_bytes",
            F.struct("partition", "preliminary", iso.alias("remote_datetime")).alias("metadata"),
        ).alias("manifest"),
    )


#: The record of one stored file, as it is written to JSON.
RECORD = ("url string, size bigint, filepath string, suffix string, dataset string, created_at timestamp_ntz, manifest struct<sha256: string, "
          "size_bytes: bigint, metadata: struct<partition: string, preliminary: boolean, remote_datetime: string>>")


def write_manifest(rows: DataFrame, path: str, mode: str = "error") -> None:
    """K3: store a manifest as nested JSON records, one a line; null fields are written too."""
    names = T.StructType.fromDDL(RECORD).names
    rows.select(*names).write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The records that ``write_manifest`` stored, typed by ``RECORD``; a line that is no such
    record raises instead of reading as nulls."""
    return spark.read.schema(RECORD).option("mode", "FAILFAST").json(path)


def transfer_stats(log: DataFrame) -> DataFrame:
    """A9 per transfer: size_mb = bytes / 10^6, rate_mbps = bytes * 8 / s / 10^6
    (null when the time is zero)."""
    return log.select(
        "*",
        (F.col("size") / F.lit(MEGA)).alias("size_mb"),
        (F.try_divide(F.col("size") * 8, F.col("seconds")) / F.lit(MEGA)).alias("rate_mbps"),
    )


def transfer_totals(log: DataFrame) -> DataFrame:
    """A9 totals per dataset (derived): files, bytes, seconds, overall rate."""
    return log.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("size").cast("bigint").alias("total_bytes"),
        F.sum("seconds").alias("total_seconds"),
    ).withColumn(
        "rate_mbps", F.try_divide(F.col("total_bytes") * 8, F.col("total_seconds")) / F.lit(MEGA)
    )
