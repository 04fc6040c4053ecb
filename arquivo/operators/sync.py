"""Sync planning over the catalog.

The catalog of a sync is the union of data entries (classified files, sliced)
and, on request, documentation and auxiliary-table entries. The plan is what
the local store does not already hold complete (same path and same size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.operators.classify import with_known_ancestors
from arquivo.operators.partition import support_local_path, with_stored_path
from arquivo.sources import registry as reg
from arquivo.sources.store import write_observed

KINDS = ("doc", "aux")


def data_entries(classified: DataFrame, root: str = "/data") -> DataFrame:
    """Data entries: the columns of the classified files with group, partition,
    type='data', url and local_path (see ``catalog_entries`` for the listed form)."""
    spark = classified.sparkSession
    g = F.broadcast(reg.datasets(spark).select("dataset", "group"))
    df = with_stored_path(classified, root).join(g, "dataset", "left")
    return df.select(
        *[c for c in df.columns if c not in ("stored_name",)],
        F.lit("data").alias("type"),
        F.col("full_path").alias("url"),
        F.col("stored_path").alias("local_path"),
    )


def support_files(files: DataFrame, kinds: Sequence[str] = KINDS, max_depth: int = 3) -> DataFrame:
    """J3 input: listed files under the documentation ('doc') and auxiliary ('aux')
    directories (up to ``max_depth`` levels below), with their key and type. One pass over
    the files serves all kinds: the type is a column of the registry."""
    spark = files.sparkSession
    sreg = F.broadcast(
        reg.support_registry(spark).where(F.col("type").isin(*kinds)).select(
            "type", F.col("key"), F.regexp_replace(F.col("support_dir"), "/+$", "").alias("_sdir")
        )
    )
    ex = with_known_ancestors(files, max_depth, reg.support_dirs(), out="_anc_dir")
    out = ex.join(sreg, F.col("_anc_dir") == F.col("_sdir"), "inner")
    return out.drop("_anc_dir", "_sdir", "depth")


def support_entries(files: DataFrame, kinds: Sequence[str] = KINDS, datasets: list[str] | None = None,
                    resolve: str = "dataset", root: str = "/data") -> DataFrame:
    """Doc/aux catalog entries for the selected datasets (H7).

    resolve='dataset' (the archive tool's rule): a support key is taken when it equals a
    selected *dataset* key. resolve='group': through the datasets' groups.
    The entry's ``dataset`` is the key, its ``local_path`` follows P8."""
    spark = files.sparkSession
    sup = support_files(files, kinds)
    sel = reg.datasets(spark)
    if datasets:
        sel = sel.filter(F.col("dataset").isin(*sorted(set(datasets))))
    if resolve == "dataset":
        keys = sel.select(F.col("dataset").alias("key"))
    elif resolve == "group":
        keys = sel.select(F.col("group").alias("key")).distinct()
    else:
        raise ValueError(f"unknown resolve {resolve!r}")
    sup = sup.join(F.broadcast(keys), "key", "left_semi")
    return sup.select(
        *[c for c in files.columns],
        F.col("key").alias("dataset"),
        F.col("key").alias("group"),
        F.col("type"),
        F.col("full_path").alias("url"),
        support_local_path(F.col("type"), F.col("key"), F.col("filename"), F.col("datetime"), root)
        .alias("local_path"),
    )


def catalog_union(data: DataFrame, *support: DataFrame) -> DataFrame:
    """Data, doc and aux entries as one table (missing columns null)."""
    out = data
    for s in support:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def select_types(entries: DataFrame, types: Sequence[str]) -> DataFrame:
    """the entries of the given types ('data', 'doc', 'aux')."""
    return entries.filter(F.col("type").isin(*types))


def catalog_entries(entries: DataFrame) -> DataFrame:
    """U2 as the archive tool lists a catalog: id (the file's name), url, group and dataset
    (both the dataset's key), partition (empty for a data file without one, null for
    support files), type, size."""
    return entries.select(F.col("filename").alias("id"), "url", F.col("dataset").alias("group"), "dataset",
                          "partition", "type", "size")


def sync_status(entries: DataFrame, local: DataFrame, path_col: str = "path", size_col: str = "size") -> DataFrame:
    """Every entry with ``status``: 'complete' if the local inventory has its path with
    its very size (H12), 'incomplete' if it has the path with other sizes only, else
    'missing'. The inventory is reduced to one row per path, so no entry is doubled."""
    loc = local.groupBy(F.col(path_col).alias("_lp")).agg(F.collect_set(size_col).alias("_sizes"))
    status = (F.when(F.col("_lp").isNull(), "missing")
              .when(F.coalesce(F.array_contains("_sizes", F.col("size")), F.lit(False)), "complete").otherwise("incomplete"))
    return entries.join(loc, F.col("local_path") == F.col("_lp"), "left").select(*entries.columns, status.alias("status"))


def sync_plan(entries: DataFrame, local: DataFrame, path_col: str = "path", size_col: str = "size") -> DataFrame:
    """Entries whose local copy is missing or incomplete."""
    return sync_status(entries, local, path_col, size_col).filter("status <> 'complete'").drop("status")


def sync_batches(plan: DataFrame) -> DataFrame:
    """Files and bytes still to fetch per dataset."""
    return plan.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_pending"),
        F.sum(F.coalesce(F.col("size"), F.lit(0))).cast("bigint").alias("pending_bytes"),
    )


def failed_files(plan: DataFrame, failed: DataFrame | None = None, predicate=None) -> DataFrame:
    """Failed transfers as rows (dataset, url) ordered by url; the report
    is distributed, never one collected list."""
    out = plan
    if failed is not None:
        out = out.join(failed.select("url"), "url", "left_semi")
    if predicate is not None:
        out = out.filter(predicate)
    return out.select("url", "dataset", "size").orderBy("url")


def failed_total(failed_rows: DataFrame) -> DataFrame:
    """Count (and bytes) of failed files."""
    return failed_rows.agg(
        F.count(F.lit(1)).alias("n_failed"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("failed_bytes"),
    )


def dry_run(entries: DataFrame) -> DataFrame:
    """A6 rows: dataset, type, partition, size, url (no anti join, as in the
    reference's dry run)."""
    return entries.select("dataset", "type", "partition", "size", "url")


def dry_run_total(entries: DataFrame) -> DataFrame:
    """A6 total: files and bytes of the selection."""
    return entries.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum(F.coalesce(F.col("size"), F.lit(0))), F.lit(0)).cast("bigint").alias("total_bytes"),
    )


def dry_run_once(entries: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """A6 rows and total of one pass over ``entries``: (rows, stored at ``path``; the total)."""
    rows, total = write_observed(
        dry_run(entries), path, n_files=F.count(F.lit(1)), total_bytes=F.coalesce(F.sum("size"), F.lit(0)).cast("bigint"))
    return rows, entries.sparkSession.createDataFrame([(total["n_files"], total["total_bytes"])], "n_files long, total_bytes long")


def path_collisions(entries: DataFrame) -> DataFrame:
    """Stored paths shared by several remote files (H11), with the count."""
    return entries.groupBy(F.col("local_path")).agg(F.count(F.lit(1)).alias("n_files")).filter(
        F.col("n_files") > 1
    )
