"""Local store inventory: stored-name parsing, most recent version, archive plan
(P9, P10, W1, W2, K2, H5, H6, H9).

Grouping is by (directory, partition string); within a group the file *name*
orders the versions and the last name is the most recent. Nothing here sends a
whole group to one task: the latest name per group is a partial aggregate, and
positions within a group come from a range-partitioned sort, so a group holding
a third of all files is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arquivo.functions.columns import join_path, path_stem, path_suffix

GROUP_KEYS = ("dir", "partition")


def parse_store_names(df: DataFrame, name_col: str = "name") -> DataFrame:
    """P9 on (dir, name, size, ...): adds dataset, partition, date (DATE),
    extension (with its dot), valid and reject_reason.

    Stem = name without its last suffix; split at the last '@' into base and
    date; base split at the first '_' into dataset and partition ('' if none);
    the date must be eight digits yyyyMMdd (H9).

    The parsed fields come out of an ``inline_outer`` step, so filters on them
    (valid / invalid) stay above the parse instead of being rewritten into the
    scan below it."""
    name = F.col(name_col)
    # Each step is its own projection, so every intermediate is computed once.
    a = df.select("*", path_stem(name).alias("_stem"), path_suffix(name).alias("_ext"))
    stem = F.col("_stem")
    b = a.select(
        "*",
        stem.contains("@").alias("_has_at"),
        F.when(stem.contains("@"), F.regexp_extract(stem, r"^(.*)@[^@]*$", 1)).alias("_base"),
        F.when(stem.contains("@"), F.substring_index(stem, "@", -1)).alias("_date_txt"),
    )
    base, date_txt = F.col("_base"), F.col("_date_txt")
    has_us = base.contains("_")
    parsed = F.struct(
        F.when(has_us, F.substring_index(base, "_", 1)).otherwise(base).alias("dataset"),
        F.when(has_us, F.regexp_extract(base, r"^[^_]*_(.*)$", 1)).otherwise(F.lit("")).alias("partition"),
        F.when(date_txt.rlike("^[0-9]{8}$"), F.try_to_date(date_txt, "yyyyMMdd")).alias("date"),
        F.col("_ext").alias("extension"),
        F.col("_has_at").alias("has_at"),
    )
    t = b.select(*df.columns, F.inline_outer(F.array(parsed)))
    out = t.select(
        *df.columns, "dataset", "partition", "date", "extension",
        F.when(~F.col("has_at"), F.lit("missing '@' separator"))
        .when(F.col("date").isNull(), F.lit("bad date"))
        .alias("reject_reason"),
    )
    return out.withColumn("valid", F.col("reject_reason").isNull())


def valid_store_files(parsed: DataFrame) -> DataFrame:
    """P10: the rows whose names parse."""
    return parsed.filter(F.col("valid")).drop("reject_reason")


def store_rejects(parsed: DataFrame) -> DataFrame:
    """P10: names that do not parse, with the reason (the reference skips them)."""
    return parsed.filter(~F.col("valid"))


def most_recent(files: DataFrame, keys: tuple[str, ...] = GROUP_KEYS, name_col: str = "name") -> DataFrame:
    """Adds ``is_most_recent`` = the file has the greatest name of its group.

    The greatest name per group is a partial aggregate (one row per group and
    map task before the shuffle); it is joined back on (group keys, name),
    which is unique per file, so the join has no hot key."""
    latest = files.groupBy(*keys).agg(F.max(name_col).alias(name_col)).withColumn(
        "_latest", F.lit(True)
    )
    return files.join(latest, [*keys, name_col], "left").withColumn(
        "is_most_recent", F.coalesce(F.col("_latest"), F.lit(False))
    ).drop("_latest")


def version_positions(files: DataFrame, keys: tuple[str, ...] = GROUP_KEYS, name_col: str = "name",
                      slice_chars: int = 6) -> DataFrame:
    """``position`` 1..n of each file within its group by name, and ``n``.

    A group is numbered in slices: the part of a name up to its first '@' and the first
    ``slice_chars`` characters after it (year and month of the version). That part orders
    as the names do, so a file's position is its number within its slice plus the sizes
    of the slices before. Slices are cut by the names alone: no sampling, nothing written,
    and a group with a third of all files spans as many tasks as it has months. Names
    without '@' are slices of their own."""
    part = files.withColumn("_slice", F.regexp_extract(name_col, r"(?s)^([^@]*(?:@.{0," + str(slice_chars) + r"})?)", 1))
    local = part.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(name_col)))
    size = part.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*keys).orderBy("_slice")
    size = size.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*keys)).alias("n"),
    )
    same = F.col("_slice") == F.col("_s")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = local.join(size, same, "inner")
    return out.select(*files.columns, F.col("n").cast("bigint").alias("n"),
                      (F.col("_local") + F.col("_off")).cast("bigint").alias("position"))


SUPPORT_TREES = ("_documentacao", "_auxiliar")


def archive_plan(flagged: DataFrame, root: str, archive_root: str, include_support: bool = False) -> DataFrame:
    """K2: every file that is not the most recent of its group, with its source
    path and its destination (same path relative to the archive root).

    Input: a flagged inventory with ``dir`` relative to the store root (two
    levels: dataset/partition_dir). The support trees are left out unless
    ``include_support`` (the reference walks them too, H6)."""
    out = flagged.filter(~F.col("is_most_recent"))
    if not include_support:
        out = out.filter(~F.substring_index(F.col("dir"), "/", 1).isin(*SUPPORT_TREES))
    rel = F.concat(F.col("dir"), F.lit("/"), F.col("name"))
    return out.withColumn("src_path", join_path(F.lit(root.rstrip("/")), rel)).withColumn(
        "dest_path", join_path(F.lit(archive_root.rstrip("/")), rel)
    )
