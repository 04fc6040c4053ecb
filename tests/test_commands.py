"""The list / sync / archive commands over small inputs."""

from arquivo.plans.commands import archive, list_datasets, sync
from arquivo.sources.registry import BASE

LINES = [
    (BASE + "/SIHSUS/200801_/Dados", "01-15-24  10:00AM  2097152 RDSP2001.dbc"),
    (BASE + "/SIHSUS/200801_/Dados", "01-15-24  10:00AM  1048576 RDRJ2002.dbc"),
    (BASE + "/SIHSUS/199201_200712/Dados", "01-15-24  10:00AM  10 RDSP9901.dbc"),
    (BASE + "/SIHSUS/200801_/Dados", "01-15-24  10:00AM  10 SPSP2001.dbc"),
    (BASE + "/SIHSUS/200801_/Dados", "01-15-24  10:00AM  10 LEIAME.txt"),
    (BASE + "/CIHA/201101_/Doc", "01-15-24  10:00AM  7 Manual.PDF"),
    (BASE + "/CIHA/201101_/Auxiliar", "01-15-24  10:00AM  8 tabs.zip"),
    (BASE + "/CIHA/201101_/Dados", "01-15-24  10:00AM  9 CIHASP2001.dbc"),
]


def _listing(spark):
    return spark.createDataFrame(LINES, "dir string, line string")


def test_list(spark):
    summary, totals, unknown = list_datasets(_listing(spark), ["sih-rd", "ciha", "nope"])
    rows = [tuple(r) for r in summary.collect()]
    assert rows == [("ciha", 1, 9, "2020-01", "2020-01"), ("sih-rd", 3, 3145738, "1999-01", "2020-02")]
    assert tuple(totals.first()) == (4, 3145747)
    assert [r.dataset for r in unknown.collect()] == ["nope"]


def test_sync_dry_run_and_plan(spark):
    dry = sync(_listing(spark), datasets=["sih-rd", "ciha"], start="2020", regions=["sp"],
               docs=True, aux=True, dry_run=True)
    got = sorted((r.type, r.dataset, r.local_path) for r in dry.collect())
    assert got == [
        ("aux", "ciha", "/data/_auxiliar/ciha/tabs@20240115.zip"),
        ("data", "ciha", "/data/ciha/202001/ciha_202001-sp@20240115.dbc"),
        ("data", "sih-rd", "/data/sih-rd/202001/sih-rd_202001-sp@20240115.dbc"),
        ("doc", "ciha", "/data/_documentacao/ciha/Manual@20240115.PDF"),
    ]
    local = spark.createDataFrame(
        [("/data/sih-rd/202001/sih-rd_202001-sp@20240115.dbc", 2097152),
         ("/data/ciha/202001/ciha_202001-sp@20240115.dbc", 8)], "path string, size bigint")
    todo = sync(_listing(spark), local, datasets=["sih-rd", "ciha"], start="2020", regions=["sp"])
    assert sorted(r.local_path for r in todo.collect()) == ["/data/ciha/202001/ciha_202001-sp@20240115.dbc"]


def test_archive(spark):
    inv = spark.createDataFrame(
        [("sih-rd/202001", "sih-rd_202001-sp@20230101.dbc", 1), ("sih-rd/202001", "sih-rd_202001-sp@20240101.dbc", 1),
         ("sih-rd/202001", "sih-rd-preliminar_202001-sp@20250101.dbc", 1)], "dir string, name string, size bigint")
    moves = sorted(r.src_path for r in archive(inv, "/data", "/old").collect())
    assert moves == ["/data/sih-rd/202001/sih-rd-preliminar_202001-sp@20250101.dbc",
                     "/data/sih-rd/202001/sih-rd_202001-sp@20230101.dbc"]


def test_building_a_sync_runs_no_job(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    sync(_listing(spark), datasets=["ciha"], docs=True, aux=True, dry_run=True)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
