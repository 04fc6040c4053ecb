"""Partition key, partition directory and local paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arquivo.functions import columns as c


def with_partition(df: DataFrame) -> DataFrame:
    """P5 + P6: adds ``partition`` (key string) and ``partition_dir``."""
    return df.withColumn(
        "partition", c.partition_key("uf", "year", "month", "version")
    ).withColumn("partition_dir", c.partition_dir("year", "month"))


def _root(root: str) -> Column:
    return F.lit(root.rstrip("/") or "/")


def with_stored_path(df: DataFrame, root: str = "/data") -> DataFrame:
    """``stored_name`` and ``stored_path`` = root/dataset[/partition_dir]/name.

    The stamp is the remote file date (``datetime``)."""
    if "partition" not in df.columns or "partition_dir" not in df.columns:
        df = with_partition(df)
    name = c.stored_name("dataset", "preliminary", "partition", F.col("datetime"), "extension")
    df = df.withColumn("stored_name", name)
    return df.withColumn(
        "stored_path",
        c.join_path(_root(root), F.col("dataset"), F.col("partition_dir"), F.col("stored_name")),
    )


SUPPORT_DIRS = {"doc": "_documentacao", "aux": "_auxiliar"}


def support_local_path(type_: Column, dataset: Column, filename: Column, stamp: Column,
                       root: str = "/data", id_: Column | None = None) -> Column:
    """out/_documentacao|_auxiliar/{dataset}/{stem}@{YYYYMMDD}.{ext}.

    The name is split at its last dot and the extension keeps its case; a name
    without a dot has no path (the reference raises). Any other type gives
    out/{id}."""
    has_dot = filename.contains(".")
    stem = F.regexp_extract(filename, r"^(.*)\.([^.]*)$", 1)
    ext = F.regexp_extract(filename, r"^(.*)\.([^.]*)$", 2)
    name = F.concat(stem, F.lit("@"), F.date_format(stamp, "yyyyMMdd"), F.lit("."), ext)
    sub = F.when(type_ == "doc", F.lit(SUPPORT_DIRS["doc"])).when(type_ == "aux", F.lit(SUPPORT_DIRS["aux"]))
    other = c.join_path(_root(root), F.coalesce(id_ if id_ is not None else filename, F.lit("unknown")))
    return F.when(
        sub.isNotNull(), F.when(has_dot, c.join_path(_root(root), sub, dataset, name))
    ).otherwise(other)
