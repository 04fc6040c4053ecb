"""File sources and sinks: listing dumps (S1), store scan (S5), manifests (K3), catalog (K1)."""

import hashlib
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from arquivo.operators.classify import classify
from arquivo.operators.listing import listing_files, parse_listing
from arquivo.operators.manifest import manifest
from arquivo.operators.partition import with_partition
from arquivo.plans.commands import archive, sync
from arquivo.sources.listing import read_listing, write_listing
from arquivo.sources.registry import BASE
from arquivo.sources.store import hash_files, read_catalog, scan_store, store_files, write_catalog


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_listing_dumps_latin1(spark, tmpdir_fresh):
    d = BASE + "/SIHSUS/200801_/Dados"
    target = os.path.join(tmpdir_fresh, "dumps")
    lines = ["10-15-97  01:05PM   1234 RDSP9710.dbc", "10-15-97  01:05PM   99 LEIAME ação.txt"]
    # a dump written by hand in Latin-1, in the partition layout the reader expects
    from urllib.parse import quote
    part = os.path.join(target, "dir=" + quote(d, safe=""))
    _write(os.path.join(part, "part-0.txt"), ("\r\n".join(lines) + "\r\n").encode("latin-1"))
    df = read_listing(spark, target)
    got = sorted((r.dir, r.line.rstrip("\r")) for r in df.collect())
    assert got == sorted((d, ln) for ln in lines)
    # round trip through the writer, by default arguments
    out = os.path.join(tmpdir_fresh, "dumps2")
    odd = df.union(spark.createDataFrame([("/x y", "  two  blanks "), ("/x y", 'a "quoted", one')], "dir string, line string"))
    odd = odd.withColumn("line", F.rtrim(F.col("line"), F.lit("\r")))
    write_listing(odd, out)
    assert sorted(map(tuple, read_listing(spark, out).collect())) == sorted(map(tuple, odd.collect()))
    classified = classify(listing_files(parse_listing(df.withColumn("line", F.rtrim("line")))))
    assert [r.dataset for r in classified.collect()] == ["sih-rd"]


def test_scan_store_and_archive(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "store")
    for rel, data in {
        "po/2031/po_2031-pe@20310101.dbc": b"abc", "po/2031/po_2031-pe@20320101.dbc": b"abcd",
        "po/2031/po_2031-pe@20330101.dbc": b"",             # the newest is empty, and counts
        "po/2031/nodate.dbc": b"-", "po/2031/nodot": b"-", "po/loose@20310101.dbc": b"x", "po/2031/deep/po@20310101.dbc": b"x",
        "_documentacao/po/Notas@20310101.pdf": b"zz", "_auxiliar/po/t@20310101.zip": b"z",
    }.items():
        _write(os.path.join(root, rel), data)
    for given in (root, "file://" + root + "/"):
        inv = scan_store(spark, given)
        rows = sorted((r.path, r.dir, r.name, r.size) for r in inv.collect())
        assert rows == sorted((f"{root}/{d}/{n}", d, n, size) for d, n, size in [
            ("_auxiliar/po", "t@20310101.zip", 1), ("_documentacao/po", "Notas@20310101.pdf", 2), ("po/2031", "nodate.dbc", 1),
            ("po/2031", "po_2031-pe@20310101.dbc", 3), ("po/2031", "po_2031-pe@20320101.dbc", 4), ("po/2031", "po_2031-pe@20330101.dbc", 0)])
    moves = archive(inv, root, "/old").collect()
    assert sorted(r.src_path for r in moves) == [f"{root}/po/2031/po_2031-pe@20310101.dbc", f"{root}/po/2031/po_2031-pe@20320101.dbc"]
    assert store_files(spark, root).count() == 9


def test_a_complete_store_needs_no_sync(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "data")
    listing = spark.createDataFrame(
        [(BASE + "/SIHSUS/200801_/Dados", "10-15-97  01:05PM   4 RDSP9710.dbc"), (BASE + "/SIHSUS/200801_/Dados", "10-15-97  01:05PM  0 RDTO9711.dbc"),
         (BASE + "/CIHA/201101_/Doc", "01-15-24  10:00AM  7 Manual.PDF")], "dir string, line string")
    entries = sync(listing, root=root, docs=True, dry_run=True)
    assert entries.count() == 3
    for r in entries.collect():
        _write(r.local_path, b"DATADATA"[: r.size])
    everything = store_files(spark, root)
    assert sync(listing, scan_store(spark, root), root=root, docs=True).collect() == []
    _write(os.path.join(root, "sih-rd", "unlisted.dbc"), b"own")
    rows = {r.filepath: r for r in manifest(hash_files(everything), entries).collect()}
    assert len(rows) == 4
    for r in entries.collect():
        data = b"DATADATA"[: r.size]
        m = rows[r.local_path]
        assert (m.sha256, m.size_bytes, m.dataset, m.url) == (hashlib.sha256(data).hexdigest(), r.size, r.dataset, r.url)
    own = rows[os.path.join(root, "sih-rd", "unlisted.dbc")]
    assert own.dataset is None and own.sha256 == hashlib.sha256(b"own").hexdigest()


def test_write_catalog_partitions(spark, tmpdir_fresh):
    listing = spark.createDataFrame(
        [(BASE + "/SIHSUS/200801_/Dados", "10-15-97  01:05PM   4 RDSP9710.dbc"),
         (BASE + "/SINASC/1996_/Dados/DNRES", "10-15-97  01:05PM   4 DNEX2015.dbc")], "dir string, line string")
    cat = with_partition(classify(listing_files(parse_listing(listing))))
    cat = cat.withColumn("partition_dir", F.when(F.col("dataset") == "sih-rd", "").otherwise(F.col("partition_dir")))
    out = os.path.join(tmpdir_fresh, "catalog")
    write_catalog(cat, out)
    back = read_catalog(spark, out)
    assert dict(back.dtypes) == dict(cat.dtypes)
    assert sorted(map(str, back.select(*cat.columns).collect())) == sorted(map(str, cat.collect()))
    assert back.filter("partition_dir = ''").count() == 1
    one = back.filter("dataset = 'sinasc-dnex' AND partition_dir = '2015'")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan  # folders of other datasets are not listed
    with pytest.raises(AnalysisException):
        write_catalog(cat, out)  # never replaces a catalog unasked
