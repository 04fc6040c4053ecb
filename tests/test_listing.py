"""Listing lines."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from arquivo.operators.listing import bad_sizes, listing_files, listing_rejects, listing_subdirs, parse_listing


def _parse(spark, lines, dir_="/a/b"):
    return parse_listing(spark.createDataFrame([(dir_, ln) for ln in lines], "dir string, line string"))


def test_parse_fields(spark):
    df = _parse(spark, [
        "10-15-97  01:05PM              1234 RDSP9710.dbc",
        "01-02-03  12:00AM               n/a tab 10 .zip  ",
        "1-2-68  12:30PM   7 x",
        "01-01-20  10:00AM       <DIR>          Dados",
        "garbage",
    ])
    rows = df.collect()
    r = rows[0]
    assert (r.filename, r.size, r.extension, r.datetime, r.full_path) == (
        "RDSP9710.dbc", 1234, "dbc", dt.datetime(1997, 10, 15, 13, 5), "/a/b/RDSP9710.dbc")
    r = rows[1]
    assert (r.filename, r.size, r.size_invalid, r.extension, r.datetime) == (
        "tab 10 .zip  ", 0, True, "zip  ", dt.datetime(2003, 1, 2, 0, 0))
    assert rows[2].datetime == dt.datetime(2068, 1, 2, 12, 30)
    assert rows[3].is_dir and rows[3].filename == "Dados"
    assert rows[4].parse_error is not None
    files = listing_files(df)
    assert files.count() == 3
    assert listing_rejects(df).count() == 1
    assert bad_sizes(df).count() == 1
    assert [r.child for r in listing_subdirs(df).collect()] == ["/a/b/Dados"]


def test_no_extension(spark):
    r = _parse(spark, ["01-01-20  10:00AM  5 LEIAME"]).first()
    assert r.extension is None and r.filename == "LEIAME"


def test_failfast(spark):
    df = _parse(spark, ["13-45-20  10:00AM  5 bad.dbc"])
    assert listing_files(df).count() == 0
    with pytest.raises((Py4JJavaError, PySparkException)):
        listing_files(df, mode="FAILFAST").collect()


def test_bounded_walk(spark):
    from arquivo.operators.listing import files_in_walk, reachable_dirs
    lines = [
        ("/r", "01-01-20  10:00AM  <DIR>  a"), ("/r/a", "01-01-20  10:00AM  <DIR>  b"),
        ("/r/a/b", "01-01-20  10:00AM  <DIR>  c"), ("/r/a/b/c", "01-01-20  10:00AM  <DIR>  d"),
        ("/r/a/b/c", "01-01-20  10:00AM  3 f3.dbc"), ("/r/a/b/c/d", "01-01-20  10:00AM  4 f4.dbc"),
        ("/r", "01-01-20  10:00AM  0 f0.dbc"),
    ]
    parsed = parse_listing(spark.createDataFrame(lines, "dir string, line string"))
    starts = spark.createDataFrame([("/r",)], "dir string")
    walk = reachable_dirs(listing_subdirs(parsed), starts, 3)
    assert sorted((r.dir, r.depth) for r in walk.collect()) == [
        ("/r", 0), ("/r/a", 1), ("/r/a/b", 2), ("/r/a/b/c", 3)]
    got = sorted((r.filename, r.depth) for r in files_in_walk(listing_files(parsed), walk).collect())
    assert got == [("f0.dbc", 0), ("f3.dbc", 3)]       # f4 lies four levels down
