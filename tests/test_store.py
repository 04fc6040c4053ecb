"""Local store: stored-name parsing, most recent, positions, archive."""

import datetime as dt

from pyspark.sql import functions as F

from arquivo.operators.partition import with_stored_path
from arquivo.operators.store import (
    archive_plan,
    most_recent,
    parse_store_names,
    store_rejects,
    valid_store_files,
    version_positions,
)


def _store(spark, rows):
    return spark.createDataFrame(rows, "dir string, name string, size bigint")


def test_reject_reasons(spark):
    names = {"po_1987@20310230.dbc": "bad date", "po_1987@2031.dbc": "bad date", "po_1987.dbc": "missing '@' separator",
             "@20310509": None, "po@x@20310509.tar.gz": "bad date"}
    rows = parse_store_names(_store(spark, [("d", n, 1) for n in names])).collect()
    assert {r.name: r.reject_reason for r in rows} == names
    parsed = parse_store_names(_store(spark, [("d", n, 1) for n in names]))
    assert valid_store_files(parsed).count() == 1 and store_rejects(parsed).count() == 4


def test_a_final_name_beats_a_preliminary_one(spark):
    names = ["pce_2031-pe@20310101.dbc", "pce-preliminar_2031-pe@20390101.dbc", "pce_2031-to@20300101.dbc"]
    flagged = most_recent(valid_store_files(parse_store_names(_store(spark, [("pce/2031", n, 0) for n in names]))))
    assert {r.name for r in flagged.where("is_most_recent").collect()} == {names[0], names[2]}
    assert most_recent(valid_store_files(parse_store_names(_store(spark, [])))).count() == 0


def test_positions_of_a_large_group(spark):
    days = [f"{2000 + y}{m:02d}{d:02d}" for y in range(4) for m in range(1, 13) for d in range(1, 29)]
    large = [("large", f"po_1987@{x}.dbc", 1) for x in days]
    small = [(f"small{i}", "po_1987@20310509.dbc", 1) for i in range(20)]
    files = valid_store_files(parse_store_names(_store(spark, large + small)))
    out = version_positions(files)
    rows = out.filter(F.col("dir") == "large").orderBy("name").collect()
    assert [r.position for r in rows] == list(range(1, len(days) + 1)) and {r.n for r in rows} == {len(days)}
    assert {(r.position, r.n) for r in out.filter("dir <> 'large'").collect()} == {(1, 1)}


def test_archive_plan(spark):
    df = valid_store_files(parse_store_names(_store(spark, [
        ("sih-rd/202001", "sih-rd_202001-sp@20230101.dbc", 1),
        ("sih-rd/202001", "sih-rd_202001-sp@20240101.dbc", 1),
        ("_documentacao/sih", "Leia@20230101.pdf", 1),
        ("_documentacao/sih", "Leia@20240101.pdf", 1),
    ])))
    plan = archive_plan(most_recent(df), "/data/", "/arch").collect()
    assert [(r.src_path, r.dest_path) for r in plan] == [
        ("/data/sih-rd/202001/sih-rd_202001-sp@20230101.dbc", "/arch/sih-rd/202001/sih-rd_202001-sp@20230101.dbc")]
    assert archive_plan(most_recent(df), "/data", "/arch", include_support=True).count() == 2


def test_round_trip_stored_name(spark):
    rows = [("sp", 2020, 1, None, False, "sih-rd"), (None, 2023, None, None, True, "sinasc-dnex"),
            ("sp", 2008, 1, "a", False, "sia-pa"), ("rj", 2015, None, None, False, "sinan-deng")]
    df = spark.createDataFrame(rows, "uf string, year int, month int, version string, preliminary boolean, "
                                     "dataset string")
    df = df.withColumn("datetime", F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")) \
        .withColumn("extension", F.lit("dbc"))
    stored = with_stored_path(df, "/data").select(
        F.col("partition_dir").alias("dir"), F.col("stored_name").alias("name"), F.lit(1).alias("size"),
        F.col("dataset").alias("d0"), F.col("partition").alias("p0"), "preliminary")
    back = parse_store_names(stored).collect()
    for r in back:
        ds = r.d0 + ("-preliminar" if r.preliminary else "")
        assert (r.dataset, r.partition, r.date, r.extension) == (ds, r.p0, dt.date(2024, 1, 15), ".dbc")
