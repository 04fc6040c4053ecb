"""Partition keys, partition directories, stored names and paths."""

import datetime as dt

from pyspark.sql import functions as F

from arquivo.functions.columns import partition_dir, partition_key
from arquivo.operators.partition import support_local_path, with_stored_path

#: Which of (uf, year, month) are given, and how they are written. Others give nothing.
TEMPLATES = {(0, 1, 0): "{year}", (1, 0, 0): "{uf}", (1, 1, 0): "{year}-{uf}", (1, 1, 1): "{year}{month:02}-{uf}"}
FIELDS = [(uf, year, month, version) for uf in (None, "PE", "to") for year in (None, 1987, 2031)
          for month in (None, 4, 11) for version in (None, "", "Q", "Tab 7")]


def expected_key(uf, year, month, version):
    given = tuple(int(x is not None) for x in (uf, year, month))
    parts = [TEMPLATES.get(given, "").format(uf=uf, year=year, month=month), version or ""]
    return "-".join(p for p in parts if p).lower()


def test_key_and_directory_of_every_combination(spark):
    df = spark.createDataFrame(FIELDS, "uf string, year int, month int, version string")
    rows = df.select("*", partition_key("uf", "year", "month", "version").alias("k"), partition_dir("year", "month").alias("d")).collect()
    for r in rows:
        assert r.k == expected_key(r.uf, r.year, r.month, r.version)
        assert r.d == ("" if r.year is None else f"{r.year}{r.month:02}" if r.month else str(r.year))


def test_stored_names_and_paths(spark):
    rows = [
        ("pe", 1987, 11, None, False, "siasus-x", "csv", "siasus-x/198711/siasus-x_198711-pe@20310509.csv"),
        (None, 2031, None, None, True, "anual", "dbf", "anual/2031/anual-preliminar_2031@20310509.dbf"),
        ("to", 2031, 4, "q", True, "mensal", "dbc", "mensal/203104/mensal-preliminar_203104-to-q@20310509.dbc"),
        (None, None, None, "malha", False, "mapas", "zip", "mapas/mapas_malha@20310509.zip"),
        (None, None, None, None, False, "solto", "txt", "solto/solto@20310509.txt"),
    ]
    df = spark.createDataFrame([r[:7] for r in rows], "uf string, year int, month int, version string, "
                               "preliminary boolean, dataset string, extension string")
    df = df.withColumn("datetime", F.lit(dt.datetime(2031, 5, 9, 8, 30)).cast("timestamp_ntz"))
    for root in ("/acervo", "/acervo/"):
        got = {r.dataset: r for r in with_stored_path(df, root).collect()}
        for r in rows:
            assert got[r[5]].stored_path == f"/acervo/{r[7]}"
            assert got[r[5]].stored_name == r[7].rsplit("/", 1)[1]


def test_support_paths(spark):
    df = spark.createDataFrame(
        [("doc", "cih", "Notas v1.2.Docx"), ("aux", "pce", "uf.ZIP"), ("doc", "pce", "SEMPONTO"), ("other", "pce", "solto.bin")],
        "type string, key string, filename string",
    ).withColumn("ts", F.lit(dt.datetime(2031, 5, 9)).cast("timestamp_ntz"))
    out = [r[0] for r in df.select(support_local_path(F.col("type"), F.col("key"), F.col("filename"),
                                                      F.col("ts"), "/acervo")).collect()]
    assert out == ["/acervo/_documentacao/cih/Notas v1.2@20310509.Docx", "/acervo/_auxiliar/pce/uf@20310509.ZIP",
                   None, "/acervo/solto.bin"]
