"""End-to-end catalog plans over the driver's tables.

Each function takes (spark, sf_dir) and returns a DataFrame; nothing is
collected; those of stored tables write them in the session's shared folder first. The listing is derived from ``orders`` and the store inventory from
``lineitem`` (see ``arquivo.sources.fixtures``); they are whole tables, never
sampled.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arquivo.operators import classify as C
from arquivo.operators import listing as LS
from arquivo.operators import manifest as M
from arquivo.operators import reports as R
from arquivo.operators import store as ST
from arquivo.operators import summary as SU
from arquivo.operators import sync as SY
from arquivo.operators.partition import with_partition
from arquivo.operators.slicer import Slicer
from arquivo.session import scratch_path
from arquivo.sources import fixtures as fx
from arquivo.sources import registry as reg
from arquivo.sources import store as S
from arquivo.sources.listing import read_listing, write_listing

ROOT = "/data"
ARCHIVE_ROOT = "/archive"


# --- listing ----------------------------------------------------------------

def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.remote_listing(spark, sf_dir).select("id", "dir", "line")


def parsed_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LS.parse_listing(listing_lines(spark, sf_dir))


def listing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LS.listing_files(parsed_listing(spark, sf_dir))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classify(listing_files(spark, sf_dir))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SY.data_entries(classified(spark, sf_dir), ROOT)


SUPPORT_DIR_LIST = sorted(reg.support_dirs())


def support_listing_sql() -> str:
    """Support-file fixture: all lines of the listing, moved into the documentation /
    auxiliary directories (one in five one level deeper)."""
    n = len(SUPPORT_DIR_LIST)
    case = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(SUPPORT_DIR_LIST))
    return (
        f"SELECT id, CASE CAST(id % {n} AS INT) {case} END "
        f"|| CASE WHEN id % 5 = 0 THEN '/old' ELSE '' END AS dir, line "
        f"FROM remote_listing"
    )


def support_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx.remote_listing(spark, sf_dir).createOrReplaceTempView("remote_listing")
    lines = spark.sql(support_listing_sql())
    return LS.listing_files(LS.parse_listing(lines))


def support(spark: SparkSession, sf_dir: str, resolve: str = "dataset") -> DataFrame:
    return SY.support_entries(support_listing(spark, sf_dir), resolve=resolve, root=ROOT)


def local_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The local store of the sync fixture: two thirds of the data entries,
    every seventh one a byte short (stale)."""
    e = entries(spark, sf_dir)
    return e.filter(F.col("id") % 3 != 0).select(
        F.col("local_path").alias("path"),
        F.when(F.col("id") % 7 == 0, F.col("size") - 1).otherwise(F.col("size")).alias("size"),
    )


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SY.sync_plan(entries(spark, sf_dir), local_copy(spark, sf_dir))


def store_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.parse_store_names(fx.local_store(spark, sf_dir))


def store_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.most_recent(ST.valid_store_files(store_parsed(spark, sf_dir)))


# --- query bodies --------------------------------------------------------------

def _ts(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def q_listing_parse(spark, sf):
    f = listing_files(spark, sf)
    return f.select("id", "dir", "filename", "extension", "size", "size_invalid",
                    _ts("datetime").alias("datetime"), "full_path")


def q_listing_bad_sizes(spark, sf):
    return LS.bad_sizes(parsed_listing(spark, sf)).select("id", "full_path", "size_text", "size")


CLASS_COLS = ["id", "dataset", "preliminary", "uf", "year", "month", "version", "size",
              "extension", "full_path", "depth"]


def _class_out(df):
    return df.select(*CLASS_COLS, _ts("datetime").alias("datetime"))


def q_classify_files(spark, sf):
    return _class_out(C.classify_by_regex(listing_files(spark, sf)))


def q_classify_equi(spark, sf):
    return _class_out(classified(spark, sf))


def q_unclassified_files(spark, sf):
    return C.unclassified(listing_files(spark, sf)).select("id", "dir", "filename")


def q_depth_filter(spark, sf):
    f = listing_files(spark, sf)
    return C.within_depth(f, reg.period_dirs(), 3).select("start_dir", "id", "full_path", "depth")


def q_partition_key(spark, sf):
    return with_partition(classified(spark, sf)).select("id", "dataset", "partition")


def q_partition_dir(spark, sf):
    return with_partition(classified(spark, sf)).select("id", "dataset", "partition_dir")


def q_stored_path(spark, sf):
    return entries(spark, sf).select("id", "dataset", F.col("local_path").alias("stored_path"))


SLICE_COLS = ["id", "dataset", "uf", "year", "month"]
SLICES = {
    "slice_time_lexicographic": Slicer(start="199801", end="2000"),
    "slice_time_calendar": Slicer(start="1998-01", end="2000", mode="calendar"),
    "slice_regions": Slicer(regions=["sp", "rj", "br"]),
    "slice_both": Slicer(start="1996", end="1999-12", regions=["sp", "mg", "ba"]),
}


def _slice_query(name):
    def q(spark, sf):
        return SLICES[name](classified(spark, sf)).select(*SLICE_COLS)
    q.__name__ = f"q_{name}"
    return q


def q_dataset_summary(spark, sf):
    return SU.dataset_summary(classified(spark, sf))


def q_dataset_summary_total(spark, sf):
    return SU.dataset_totals(classified(spark, sf))


def q_group_summary(spark, sf):
    return SU.group_summary(classified(spark, sf))


def q_unknown_datasets(spark, sf):
    """Datasets named in the local store that the registry does not know."""
    named = ST.valid_store_files(store_parsed(spark, sf)).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_files")
    )
    return SU.unknown_datasets(named)


DRY_RUN = Slicer(start="1997", regions=["sp", "rj", "mg"])


def dry_run_entries(spark, sf):
    data = DRY_RUN(entries(spark, sf))
    return SY.catalog_union(data, support(spark, sf))


def q_dry_run(spark, sf):
    return SY.dry_run(dry_run_entries(spark, sf))


def q_dry_run_once(spark, sf):
    """A6 rows and, as a row without url, their total, all from one scan."""
    rows, total = SY.dry_run_once(dry_run_entries(spark, sf), _scratch(spark, "dry-run"))
    last = total.select(*(F.lit(None).cast("string").alias(c) for c in ("dataset", "type", "partition", "url")), "n_files", "total_bytes")
    return rows.select("dataset", "type", "partition", "url", F.lit(1).cast("bigint").alias("n_files"),
                       F.col("size").alias("total_bytes")).unionByName(last)


def q_summary_once(spark, sf):
    """A1 rows and, as a row without dataset, their total, all from one scan."""
    rows, total = SU.summary_once(classified(spark, sf), _scratch(spark, "summary"))
    none = F.lit(None).cast("string")
    return rows.unionByName(total.select(
        none.alias("dataset"), "n_files", "total_bytes", none.alias("first_period"), none.alias("last_period")))


def q_listing_roundtrip(spark, sf):
    """The listing stored as dumps, read back and parsed."""
    path = _scratch(spark, "listing")
    write_listing(listing_lines(spark, sf).select("dir", "line"), path)
    f = LS.listing_files(LS.parse_listing(read_listing(spark, path)))
    return f.select("dir", "filename", "extension", "size", "size_invalid", _ts("datetime").alias("datetime"), "full_path")


def q_dry_run_total(spark, sf):
    return SY.dry_run_total(dry_run_entries(spark, sf))


def q_sync_plan(spark, sf):
    return plan(spark, sf).select("id", "dataset", "local_path", "size")


def q_sync_plan_bucketed(spark, sf):
    """J2 against an inventory stored in buckets of its path."""
    name = f"inventory_{uuid.uuid4().hex}"
    local = S.write_inventory(local_copy(spark, sf), name, scratch_path(spark, name))
    return SY.sync_plan(entries(spark, sf), local).select("id", "dataset", "local_path", "size")


def q_sync_batches(spark, sf):
    return SY.sync_batches(plan(spark, sf))


def failed_plan(spark, sf):
    """Failed transfers of the fixture: planned files that are present in the
    local store, i.e. whose copy there is incomplete (a transfer that stopped
    before the end)."""
    return SY.sync_status(entries(spark, sf), local_copy(spark, sf)).filter("status = 'incomplete'")


def q_failed_files_report(spark, sf):
    return SY.failed_files(failed_plan(spark, sf))


def q_failed_files_total(spark, sf):
    return SY.failed_total(SY.failed_files(failed_plan(spark, sf)))


def q_failed_files_given(spark, sf):
    """The report for a given set of failures: the files of every eleventh listing line
    (some of them are not in the plan)."""
    failed = listing_files(spark, sf).filter(F.col("id") % 11 == 0).select(F.col("full_path").alias("url")).distinct()
    return SY.failed_files(plan(spark, sf), failed=failed)


SELECTED = ["sih-rd", "sinasc-dn", "not-a-dataset"]


def q_selected_datasets(spark, sf):
    return SU.select_datasets(classified(spark, sf), SELECTED).select("id", "dataset", "size")


def q_selected_types(spark, sf):
    u = SY.catalog_union(entries(spark, sf), support(spark, sf, "dataset"))
    return SY.select_types(u, ["data", "doc"]).select(*SUPPORT_COLS)


def q_catalog_entries(spark, sf):
    u = SY.catalog_union(entries(spark, sf), support(spark, sf, "dataset"))
    return SY.catalog_entries(u)


SUPPORT_COLS = ["id", "type", "dataset", "url", "size", "local_path"]


def q_support_files(spark, sf):
    return support(spark, sf, "dataset").select(*SUPPORT_COLS)


def q_support_files_by_group(spark, sf):
    return support(spark, sf, "group").select(*SUPPORT_COLS)


def q_catalog_union(spark, sf):
    u = SY.catalog_union(entries(spark, sf), support(spark, sf, "dataset"))
    return u.select(*SUPPORT_COLS, "partition")


def q_path_collisions(spark, sf):
    return SY.path_collisions(entries(spark, sf))


def q_store_parse(spark, sf):
    v = ST.valid_store_files(store_parsed(spark, sf))
    return v.select("dir", "name", "dataset", "partition",
                    F.date_format("date", "yyyy-MM-dd").alias("date"), "extension", "size")


def q_store_rejects(spark, sf):
    return ST.store_rejects(store_parsed(spark, sf)).select("dir", "name", "reject_reason")


def q_most_recent(spark, sf):
    return store_flagged(spark, sf).select("dir", "name", "dataset", "partition", "is_most_recent")


def q_version_positions(spark, sf):
    v = ST.valid_store_files(store_parsed(spark, sf))
    return ST.version_positions(v).select("dir", "name", "position", "n")


def q_archive_plan(spark, sf):
    a = ST.archive_plan(store_flagged(spark, sf), ROOT, ARCHIVE_ROOT)
    return a.select("src_path", "dest_path", "dataset", "partition", "size")


def _manifest(spark, sf):
    e = entries(spark, sf)
    docs = fx.table(spark, sf, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("content")
    )
    # The fixture stores the text of document k as the file of listing entry k,
    # so stored files meet their entries on that id: one join.
    return M.manifest(M.hash_contents(docs), e, path_col="doc_id", entry_key="id")


def q_manifest(spark, sf):
    m = _manifest(spark, sf)
    return m.select("url", "size", "filepath", "suffix", "dataset", "sha256", "size_bytes",
                    "partition", "preliminary", "remote_datetime")


def q_manifest_by_path(spark, sf):
    """Stored files meet their entries by stored path; every document is a stored file, at
    the path of the entry of its number or at one that no entry has."""
    e = entries(spark, sf)
    at = e.select(F.col("id").alias("doc_id"), F.col("local_path").alias("path"))
    docs = fx.table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    stored = M.hash_contents(docs).join(at, "doc_id", "left").withColumn(
        "path", F.coalesce("path", F.concat(F.lit(ROOT + "/unlisted/"), F.col("doc_id").cast("string"))))
    return M.manifest(stored, e).select("url", "filepath", "dataset", "sha256", "size_bytes", "partition", "remote_datetime")


def q_store_manifest(spark, sf):
    """Every document written as a file of a store, at the stored path of the entry of its number
    or, where there is none or a smaller number has it, under ``unlisted``; then the store is
    listed, its files hashed, and met with the entries by path."""
    e = entries(spark, sf)
    at = e.where("id IS NOT NULL").groupBy("local_path").agg(F.min("id").alias("doc_id"))
    rel = F.coalesce(F.substring(F.col("local_path"), len(ROOT) + 2, 1 << 20), F.concat(F.lit("unlisted/"), F.col("doc_id").cast("string")))
    files = (fx.table(spark, sf, "documents").join(at, "doc_id", "left")
             .select(rel.alias("path"), F.col("text").cast("binary").alias("content")))
    root = _scratch(spark, "store")
    commits = S.write_files(files, f"{root}/files", f"{root}/commits")
    stored = S.hash_files(S.store_files(spark, f"{root}/files"), root)
    stored = stored.withColumn("path", F.concat(F.lit(ROOT + "/"), F.col("dir"), F.lit("/"), F.col("name")))
    known = commits.select(F.concat(F.lit(ROOT + "/"), F.col("path")).alias("path"), "sha256").withColumn("committed", F.lit(True))
    m = M.manifest(stored.join(known, ["path", "sha256"], "left_semi"), e)
    return m.select("url", "size", "filepath", "suffix", "dataset", "sha256", "size_bytes", "partition", "preliminary", "remote_datetime")


def q_manifest_json(spark, sf):
    """The manifest stored as nested JSON records and read back."""
    path = _scratch(spark, "manifest")
    M.write_manifest(_manifest(spark, sf), path)
    r = M.read_manifest(spark, path)
    return r.select("url", "size", "filepath", "suffix", "dataset", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                    "manifest.sha256", "manifest.size_bytes", "manifest.metadata.*")


def _scratch(spark, name):
    return f"{scratch_path(spark, name)}-{uuid.uuid4().hex}"


REWRITTEN = ["sih-rd", "sim-do-cid10", "sia-pa"]


def stored_catalog(spark, sf):
    """The classified files as a stored catalog: written whole, then some datasets again."""
    path = _scratch(spark, "catalog")
    rows = with_partition(classified(spark, sf))
    S.write_catalog(rows, path, mode="replace")
    S.write_catalog(S.read_slice(spark, path, datasets=REWRITTEN).select(*rows.columns), path, mode="replace")
    return path


def q_catalog_roundtrip(spark, sf):
    r = S.read_catalog(spark, stored_catalog(spark, sf))
    return r.select(*CLASS_COLS, _ts("datetime").alias("datetime"), "partition", "partition_dir")


def q_catalog_slice(spark, sf):
    """All slices of the stored catalog, the last one for some datasets of a table only."""
    path = stored_catalog(spark, sf)
    wanted = spark.createDataFrame([(d,) for d in SELECTED], "dataset string")
    parts = [S.read_slice(spark, path, s, wanted if name == "slice_both" else None)
             .select(F.lit(name).alias("slice"), *SLICE_COLS) for name, s in SLICES.items()]
    return reduce(DataFrame.union, parts)


def directory_listing_sql() -> str:
    """Directory lines of a tree up to five levels deep, one for each order."""
    return """SELECT d.dir, '01-02-20  03:04PM  <DIR>  ' || d.name AS line FROM (
SELECT '/tree/' || CAST(t AS STRING)
    || CASE WHEN lvl > 0 THEN '/a' || CAST(a AS STRING) ELSE '' END || CASE WHEN lvl > 1 THEN '/b' || CAST(b AS STRING) ELSE '' END
    || CASE WHEN lvl > 2 THEN '/c' || CAST(c AS STRING) ELSE '' END || CASE WHEN lvl > 3 THEN '/d' || CAST(d AS STRING) ELSE '' END AS dir,
  CASE lvl WHEN 0 THEN 'a' || CAST(a AS STRING) WHEN 1 THEN 'b' || CAST(b AS STRING) WHEN 2 THEN 'c' || CAST(c AS STRING)
    WHEN 3 THEN 'd' || CAST(d AS STRING) ELSE 'e' || CAST(b AS STRING) END AS name
FROM (SELECT o_custkey % 40 AS t, o_orderkey % 5 AS lvl, o_orderkey % 3 AS a, o_orderkey % 7 AS b, o_orderkey % 2 AS c, o_orderkey % 11 AS d FROM orders) k) d"""


def q_directory_walk(spark, sf):
    """F6 over ``<DIR>`` entries, from every second directory of the tree's first level."""
    fx.table(spark, sf, "orders").createOrReplaceTempView("orders")
    lines = spark.sql(directory_listing_sql())
    starts = fx.table(spark, sf, "orders").where("o_custkey % 2 = 0").select(
        F.concat(F.lit("/tree/"), (F.col("o_custkey") % 40).cast("string")).alias("dir"))
    return LS.reachable_dirs(LS.listing_subdirs(LS.parse_listing(lines)), starts, 3)


def q_dry_run_report(spark, sf):
    """R2 as one stored report: its lines in order, a blank one and the total."""
    e = dry_run_entries(spark, sf)
    lines = R.dry_run_lines(e, "type", "dataset")
    total = R.dry_run_total_line(SY.dry_run_total(e)).select(F.lit(0).alias("position"), "line")
    path = _scratch(spark, "report")
    R.write_report(R.ordered_report(lines, ["type", "dataset", "url"], footer=total), path, ["type", "dataset", "url"])
    return R.read_report(spark, path)


def transfer_log(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("filename"),
        F.col("value").alias("seconds"),
        (F.col("user_id") * 1_000_000).alias("size"),
        F.col("event_type").alias("dataset"),
    )


def q_transfer_stats(spark, sf):
    return M.transfer_stats(transfer_log(spark, sf)).select(
        "filename", "dataset", "size", "seconds", "size_mb", "rate_mbps"
    )


def q_transfer_totals(spark, sf):
    t = M.transfer_totals(transfer_log(spark, sf))
    return t.select("dataset", "n_files", "total_bytes",
                    F.round("total_seconds", 6).alias("total_seconds"),
                    F.round("rate_mbps", 6).alias("rate_mbps"))


def q_report_lines(spark, sf):
    return R.summary_lines(SU.dataset_summary(classified(spark, sf)))


def q_report_with_header(spark, sf):
    return R.summary_report(SU.dataset_summary(classified(spark, sf)))


def q_report_totals(spark, sf):
    c = classified(spark, sf)
    tot = c.agg(F.count(F.lit(1)).alias("n_files"),
                F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("total_bytes"))
    return R.total_lines(tot)


def q_dry_run_lines(spark, sf):
    return R.dry_run_lines(dry_run_entries(spark, sf))


def q_dry_run_total_line(spark, sf):
    return R.dry_run_total_line(SY.dry_run_total(dry_run_entries(spark, sf)))


def q_transfer_lines(spark, sf):
    return R.transfer_lines(M.transfer_stats(transfer_log(spark, sf)))


QUERIES = {
    "listing_parse": q_listing_parse,
    "listing_bad_sizes": q_listing_bad_sizes,
    "classify_files": q_classify_files,
    "classify_equi": q_classify_equi,
    "unclassified_files": q_unclassified_files,
    "depth_filter": q_depth_filter,
    "partition_key": q_partition_key,
    "partition_dir": q_partition_dir,
    "stored_path": q_stored_path,
    **{k: _slice_query(k) for k in SLICES},
    "dataset_summary": q_dataset_summary,
    "dataset_summary_total": q_dataset_summary_total,
    "group_summary": q_group_summary,
    "unknown_datasets": q_unknown_datasets,
    "dry_run": q_dry_run,
    "dry_run_total": q_dry_run_total,
    "sync_plan": q_sync_plan,
    "sync_plan_bucketed": q_sync_plan_bucketed,
    "dry_run_once": q_dry_run_once,
    "summary_once": q_summary_once,
    "listing_roundtrip": q_listing_roundtrip,
    "sync_batches": q_sync_batches,
    "failed_files_report": q_failed_files_report,
    "failed_files_total": q_failed_files_total,
    "failed_files_given": q_failed_files_given,
    "selected_datasets": q_selected_datasets,
    "selected_types": q_selected_types,
    "catalog_entries": q_catalog_entries,
    "support_files": q_support_files,
    "support_files_by_group": q_support_files_by_group,
    "catalog_union": q_catalog_union,
    "path_collisions": q_path_collisions,
    "store_parse": q_store_parse,
    "store_rejects": q_store_rejects,
    "most_recent": q_most_recent,
    "version_positions": q_version_positions,
    "archive_plan": q_archive_plan,
    "manifest": q_manifest,
    "manifest_by_path": q_manifest_by_path,
    "store_manifest": q_store_manifest,
    "manifest_json": q_manifest_json,
    "catalog_roundtrip": q_catalog_roundtrip,
    "catalog_slice": q_catalog_slice,
    "directory_walk": q_directory_walk,
    "dry_run_report": q_dry_run_report,
    "transfer_stats": q_transfer_stats,
    "transfer_totals": q_transfer_totals,
    "report_lines": q_report_lines,
    "report_with_header": q_report_with_header,
    "report_totals": q_report_totals,
    "dry_run_lines": q_dry_run_lines,
    "dry_run_total_line": q_dry_run_total_line,
    "transfer_lines": q_transfer_lines,
}
