"""Stores of real files, stored catalogs and their slices, walks, reports and manifests."""

import hashlib
import json
import os

import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from arquivo.operators import listing as LS
from arquivo.operators import manifest as M
from arquivo.operators import reports as R
from arquivo.operators.slicer import Slicer
from arquivo.plans.commands import sync
from arquivo.sources import store as S
from arquivo.sources.registry import BASE

FILES = {"po/2031/a@20310101.dbc": b"abc", "po/2031/empty.dbc": b"", "_auxiliar/po/t.zip": bytes(range(256)), "top": b"x", "d/e/f/g/h.i": b"deep",
         "ação/b c.txt": "ç".encode()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_are_written_listed_and_hashed(spark, tmpdir_fresh):
    root, rows = f"{tmpdir_fresh}/files", [(p, c or None, "x") for p, c in FILES.items()]
    df = spark.createDataFrame(rows, "path string, content binary, name string")
    for attempt in ("one", "two"):  # a second run writes the same files again
        commits = S.write_files(df, f"file://{root}", f"{tmpdir_fresh}/{attempt}")
        assert {r.path: (r.size, r.sha256) for r in commits.collect()} == {
            p: (len(c), hashlib.sha256(c).hexdigest()) for p, c in FILES.items()}
    with open(f"{root}/po/2031/{S.HIDDEN}123", "w") as f:  # of a task that was lost while it wrote
        f.write("half")
    found = S.hash_files(S.store_files(spark, root)).collect()
    assert {r.path: (r.size, r.size_bytes, r.sha256) for r in found} == {
        f"{root}/{p}": (len(c), len(c), hashlib.sha256(c).hexdigest()) for p, c in FILES.items()}
    assert all(r.modified is not None for r in found)
    assert {(r.dir, r.name) for r in S.scan_store(spark, root).collect()} == {
        ("po/2031", "a@20310101.dbc"), ("po/2031", "empty.dbc"), ("_auxiliar/po", "t.zip")}


@pytest.mark.parametrize("paths", [["a", "a"], ["/a"], [""], ["a/../b"], ["a//b"], ["./a"], ["a/"], [None]])
def test_paths_that_name_no_single_file(spark, tmpdir_fresh, paths):
    df = spark.createDataFrame([(p, b"") for p in paths], "path string, content binary")
    with pytest.raises(ValueError, match="not a path"):
        S.write_files(df, f"{tmpdir_fresh}/files", f"{tmpdir_fresh}/commits")
    assert not os.path.exists(f"{tmpdir_fresh}/files")


def test_no_files(spark, tmpdir_fresh):
    df = spark.createDataFrame([], "path string, content binary")
    assert S.write_files(df, f"{tmpdir_fresh}/files", f"{tmpdir_fresh}/commits").collect() == []


def test_buckets_are_listed_with_their_name(tmpdir_fresh, monkeypatch):
    """An object store's paths begin with the bucket."""
    os.makedirs(f"{tmpdir_fresh}/bucket/data/po/2031")
    with open(f"{tmpdir_fresh}/bucket/data/po/2031/a.dbc", "wb") as f:
        f.write(b"abc")
    store = fs.SubTreeFileSystem(tmpdir_fresh, fs.LocalFileSystem())
    asked = []

    class Stores:
        from_uri = staticmethod(lambda uri: (asked.append(uri), (store, uri.split("://")[1]))[1])

    monkeypatch.setattr(fs, "FileSystem", Stores)
    assert S.located("s3://bucket/data/")[1] == "bucket/data" and S.located("gs://bucket")[1] == "bucket"
    batch = pa.RecordBatch.from_pydict({"path": ["bucket/data"], "size": [None], "is_dir": [True], "modified": [None]})
    out = pa.Table.from_batches(S.list_step("s3://bucket/data", True, True, True)(iter([batch])))
    assert out.select(["path", "size"]).to_pylist() == [{"path": "bucket/data/po/2031/a.dbc", "size": 3}]
    assert set(asked) == {"s3://bucket/data/", "gs://bucket", "s3://bucket/data"}


CATALOG = "dataset string, partition_dir string, uf string, year int, month int, size long"


def catalog_rows():
    rows = [("sih-rd", f"{y}{m:02d}", uf, y, m, y + m) for y in (1999, 2000) for m in (1, 6, 12) for uf in ("pe", "to")]
    rows += [("sim-do", str(y), uf, y, None, y) for y in (1999, 2000, 2001) for uf in ("pe", None)]
    return rows + [("base", "", None, None, None, 1)]


def stored(spark, folder):
    df = spark.createDataFrame(catalog_rows(), CATALOG)
    S.write_catalog(df, folder, mode="replace")
    return df


def rows_of(df):
    return sorted(map(str, df.select(*[f.split()[0] for f in CATALOG.split(", ")]).collect()))


def test_catalog_is_rewritten_by_partition(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/catalog"
    df = stored(spark, path)
    S.write_catalog(df, path, mode="replace")
    assert rows_of(S.read_catalog(spark, path)) == rows_of(df)
    others = {d: os.stat(os.path.join(path, d)).st_mtime_ns for d in os.listdir(path) if d.startswith("dataset=sih")}
    new = spark.createDataFrame([("sim-do", "2000", "ac", 2000, None, 5), ("base", "", "ac", None, None, 2)], CATALOG)
    S.write_catalog(new, path, mode="replace")  # two partitions with other rows
    kept = df.where("NOT (dataset = 'sim-do' AND partition_dir = '2000') AND dataset <> 'base'")
    assert rows_of(S.read_catalog(spark, path)) == rows_of(kept.union(new))
    assert others == {d: os.stat(os.path.join(path, d)).st_mtime_ns for d in others}


@pytest.mark.parametrize("slicer", [
    Slicer(), Slicer(start="2000"), Slicer(end="2000"), Slicer(start="199906", end="2000"), Slicer(start="2000-01"), Slicer(end="2000-12"),
    Slicer(start="1999-06", end="2000", mode="calendar"), Slicer(start="200006", mode="calendar"), Slicer(end="1999", mode="calendar"),
    Slicer(regions=["to", "ac"]), Slicer(start="1999-12", regions=["pe"], mode="calendar")])
def test_slices_of_a_stored_catalog(spark, tmpdir_fresh, slicer):
    path = f"{tmpdir_fresh}/catalog"
    df = stored(spark, path)
    got = S.read_slice(spark, path, slicer)
    assert rows_of(got) == rows_of(slicer(df))
    if slicer.start or slicer.end:
        filters = plan_of(got).split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "partition_dir" in filters
    for datasets in (["sih-rd", "no-such"], ["base"], []):
        want = slicer(df).where(F.col("dataset").isin(datasets)) if datasets else slicer(df)
        assert rows_of(S.read_slice(spark, path, slicer, datasets)) == rows_of(want)


def test_only_the_files_of_a_slice_are_read(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/catalog"
    stored(spark, path)
    read = S.read_slice(spark, path, Slicer(start="2000", end="200006", regions=["pe"]), ["sih-rd"])
    assert "EqualTo(uf,pe)" in plan_of(read) or "In(uf, [pe])" in plan_of(read)
    assert {f.split("/catalog/")[1].rpartition("/")[0] for f in read.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]} == {
        "dataset=sih-rd/partition_dir=200001", "dataset=sih-rd/partition_dir=200006"}
    table = spark.createDataFrame([("sim-do", 1), ("sim-do", 2), (None, 3)], "dataset string, n int")
    pruned = S.read_slice(spark, path, datasets=table)
    assert "dynamicpruning" in plan_of(pruned)
    assert {r.dataset for r in pruned.collect()} == {"sim-do"} and pruned.count() == 6


def test_walk_with_links_and_depth(spark):
    links = [("/a", "/a/b"), ("/a/b", "/a/b/c"), ("/a/b/c", "/a/b/c/d"), ("/a/b/c/d", "/a/b/c/d/e"), ("/a/b/c", "/a"), ("/a", "/a/b"), ("/z", "/a")]
    subdirs = spark.createDataFrame(links, "parent string, child string")
    starts = spark.createDataFrame([("/a",), ("/a",), ("/z",), ("/none",), (None,)], "dir string")
    walk = LS.reachable_dirs(subdirs, starts, 3).collect()
    assert sorted(map(tuple, walk)) == [
        ("/a", "/a", 0), ("/a", "/a/b", 1), ("/a", "/a/b/c", 2), ("/a", "/a/b/c/d", 3), ("/none", "/none", 0),
        ("/z", "/a", 1), ("/z", "/a/b", 2), ("/z", "/a/b/c", 3), ("/z", "/z", 0)]
    assert LS.reachable_dirs(subdirs, starts, 0).count() == 3


def test_walk_is_not_cut_by_a_row_limit(spark):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "20")
    try:
        subdirs = spark.range(200).selectExpr("'/r' AS parent", "concat('/r/', id) AS child")
        assert LS.reachable_dirs(subdirs, spark.createDataFrame([("/r",)], "dir string")).count() == 201
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")


def test_report_in_many_parts_reads_in_order(spark, tmpdir_fresh):
    lines = spark.range(5000).selectExpr("id % 7 AS a", "cast(id AS string) AS b", "concat('  line ', id, ' ') AS line").repartition(5)
    footer = spark.createDataFrame([(1, "last"), (0, "total")], "position int, line string")
    path = f"{tmpdir_fresh}/report"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a small report in parts too
    try:
        R.write_report(R.ordered_report(lines, ["a", "b"], "header", footer), path, ["a", "b"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(parts) > 1
    want = ["header"] + [f"  line {i} " for i in sorted(range(5000), key=lambda i: (i % 7, str(i)))] + ["", "total", "last"]
    assert "".join(open(os.path.join(path, p)).read() for p in parts) == "\n".join(want) + "\n"
    assert sorted(map(tuple, R.read_report(spark, path).collect())) == list(enumerate(want, 1))


def test_manifest_records(spark, tmpdir_fresh):
    listing = spark.createDataFrame([(BASE + "/SIHSUS/200801_/Dados", "10-15-97  01:05PM   4 RDSP9710.dbc")], "dir string, line string")
    entries = sync(listing, root="/data", dry_run=True)
    hashed = spark.createDataFrame([(entries.first().local_path, "aa", 4), ("/data/own", "bb", 0)], "path string, sha256 string, size_bytes long")
    rows, path = M.manifest(hashed, entries), f"{tmpdir_fresh}/manifest"
    M.write_manifest(rows, path)
    back = M.read_manifest(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.select(*back.columns).collect()))
    records = [json.loads(x) for f in sorted(os.listdir(path)) if f.endswith(".json") for x in open(os.path.join(path, f))]
    assert {r["manifest"]["metadata"]["remote_datetime"] for r in records} == {"1997-10-15T13:05:00", None}
    with open(os.path.join(path, "part-x.json"), "w") as f:
        f.write('{"url": "u", "size": "many"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE|BAD_RECORD"):
        M.read_manifest(spark, path).collect()


def test_sync_takes_any_condition(spark):
    names = ["RDSP9710.dbc", "RDTO9711.dbc", "RDPE9712.dbc"]
    listing = spark.createDataFrame([(BASE + "/SIHSUS/200801_/Dados", f"10-15-97  01:05PM   {k} {n}") for k, n in enumerate(names)]
                                    + [(BASE + "/CIHA/201101_/Doc", "01-15-24  10:00AM  7 Manual.PDF")], "dir string, line string")
    got = sync(listing, root="/data", dry_run=True, docs=True, where=(F.col("size") > 0) & (F.col("uf") != "pe"))
    assert sorted(r.filename for r in got.collect()) == ["Manual.PDF", "RDTO9711.dbc"]


def test_a_bucketed_inventory_is_not_shuffled(spark, tmpdir_fresh):
    from arquivo.operators import sync as SY
    rows = [(f"/data/p{i % 40}", i % 3) for i in range(60)] + [(None, 1)]
    plain = spark.createDataFrame(rows, "path string, size long")
    local = S.write_inventory(plain, "inventory_of_test", f"{tmpdir_fresh}/inventory")
    entries = spark.createDataFrame([(f"/data/p{i}", i % 4) for i in range(50)], "local_path string, size long")
    threshold = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        got = SY.sync_status(entries, local)
        assert plan_of(got).count("Exchange") == 1 and plan_of(SY.sync_status(entries, plain)).count("Exchange") == 2
        assert sorted(got.collect()) == sorted(SY.sync_status(entries, plain).collect())
        assert {r.status for r in got.collect()} == {"complete", "incomplete", "missing"}
    finally:
        spark.conf.set(threshold, before)
    again = S.write_inventory(plain.limit(1), "inventory_of_test", f"{tmpdir_fresh}/inventory", 2)
    assert again.count() == 1


def test_totals_of_rows_while_they_are_written(spark, tmpdir_fresh):
    from arquivo.operators import sync as SY
    cols = "dataset string, type string, partition string, size long, url string"
    for i, rows in enumerate(([("a", "data", "x", 5, "u"), ("a", "data", None, None, "v"), ("b", "doc", "y", 7, "w")], [])):
        df = spark.createDataFrame(rows, cols)
        stored, total = SY.dry_run_once(df, f"{tmpdir_fresh}/{i}")
        assert sorted(map(str, stored.collect())) == sorted(map(str, SY.dry_run(df).collect()))
        assert total.collect() == SY.dry_run_total(df).collect()
