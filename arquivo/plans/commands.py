"""The archive tool's three commands as DataFrame plans over any inputs.

* ``list_datasets``: listing lines -> parse -> classify -> per-dataset summary
  (and the grand total), for all or some datasets.
* ``sync``: classified files, sliced by period and region, plus documentation
  and auxiliary entries on request, with local paths; without ``dry_run`` only
  what the local inventory does not already hold complete.
* ``archive``: store inventory -> parsed names -> most recent flag -> the moves.

Inputs are DataFrames (a listing of ``(dir, line)`` and an inventory of
``(dir, name, size)`` or ``(path, size)``), so the same plans run on a table
of many listing snapshots, on dumps read with ``sources.listing``, or on a
stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arquivo.operators import classify as C
from arquivo.operators import listing as LS
from arquivo.operators import store as ST
from arquivo.operators import summary as SU
from arquivo.operators import sync as SY
from arquivo.operators.slicer import Slicer


def catalog(listing: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """Classified files of a (dir, line) listing."""
    return C.classify(LS.listing_files(LS.parse_listing(listing), mode=mode))


def list_datasets(listing: DataFrame, datasets: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``list``: (summary per dataset ordered by key, totals, unknown keys)."""
    cls = SU.select_datasets(catalog(listing), list(datasets or []))
    summary = SU.dataset_summary(cls)
    totals = cls.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("total_bytes"),
    )
    spark = listing.sparkSession
    requested = spark.createDataFrame([(d,) for d in sorted(set(datasets or []))], "dataset string")
    return summary, totals, SU.unknown_datasets(requested)


def sync(listing: DataFrame, local: DataFrame | None = None, *, root: str = "/data",
         datasets: Sequence[str] | None = None, start: str = "", end: str = "",
         regions: Sequence[str] | None = None, docs: bool = False, aux: bool = False,
         dry_run: bool = False, resolve: str = "dataset", slicing: str = "lexicographic", where: Column | None = None) -> DataFrame:
    """``sync``: the entries to fetch, with url, size and local path.

    ``local`` is the local inventory as (path, size), for example ``scan_store`` of the
    root; it is ignored for a dry run, which lists without checking the store. ``where`` is any
    further condition on the data files (dataset, uf, year, month, version, preliminary, size, datetime, url, ...); like
    the other bounds it leaves support files alone. Building the plan runs no job and writes nothing."""
    files = LS.listing_files(LS.parse_listing(listing))
    cls = SU.select_datasets(C.classify(files), list(datasets or []))
    entries = SY.data_entries(Slicer(start, end, regions, slicing)(cls), root)
    if where is not None:
        entries = entries.where(where)
    kinds = [k for k, on in (("doc", docs), ("aux", aux)) if on]
    if kinds:
        entries = SY.catalog_union(entries, SY.support_entries(files, kinds, list(datasets or []), resolve, root))
    if dry_run or local is None:
        return entries
    return SY.sync_plan(entries, local)


def archive(inventory: DataFrame, root: str, archive_root: str, include_support: bool = False) -> DataFrame:
    """``archive``: (src_path, dest_path) of every file that is not the most
    recent of its (directory, partition) group. ``inventory`` has (dir, name,
    size) with ``dir`` relative to ``root`` (see ``sources.store.scan_store``)."""
    flagged = ST.most_recent(ST.valid_store_files(ST.parse_store_names(inventory)))
    return ST.archive_plan(flagged, root, archive_root, include_support)
