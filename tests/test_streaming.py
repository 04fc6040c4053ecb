"""The stateless chain on a file stream equals the batch result."""

import os
from urllib.parse import quote

from arquivo.operators.classify import classify
from arquivo.operators.listing import listing_files, parse_listing
from arquivo.sources.registry import BASE
from arquivo.streaming.listing_stream import start_catalog_stream


def test_available_now_equals_batch(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "dumps")
    dumps = {
        BASE + "/SIHSUS/200801_/Dados": ["10-15-97  01:05PM   1234 RDSP9710.dbc",
                                         "10-15-97  01:05PM   1 SPRJ0801.dbc", "10-15-97  01:05PM   1 X.txt"],
        "/territorio/tabelas": ["01-01-20  10:00AM   5 tab 1.zip"],
        BASE + "/SINAN/DADOS/PRELIM": ["01-01-20  10:00AM   5 DENGSP24.dbc"],
    }
    for d, lines in dumps.items():
        p = os.path.join(root, "dir=" + quote(d, safe=""))
        os.makedirs(p)
        with open(os.path.join(p, "part-0.txt"), "w", encoding="latin-1") as f:
            f.write("\n".join(lines) + "\n")
    sink = os.path.join(tmpdir_fresh, "catalog")
    q = start_catalog_stream(spark, root, sink, checkpoint=os.path.join(tmpdir_fresh, "ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink).select("dataset", "uf", "year", "month", "version")
    batch_lines = spark.createDataFrame([(d, ln) for d, ls in dumps.items() for ln in ls], "dir string, line string")
    batch = classify(listing_files(parse_listing(batch_lines))).select("dataset", "uf", "year", "month", "version")
    assert streamed.count() == 4
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_restart_from_another_process(spark, tmpdir_fresh):
    """A second process finds the progress of the first: no dump is lost or doubled."""
    import subprocess
    import sys

    root, sink = os.path.join(tmpdir_fresh, "dumps"), os.path.join(tmpdir_fresh, "catalog")
    code = ("import sys; from arquivo.session import build_session; from arquivo.streaming.listing_stream import start_catalog_stream;"
            "s = build_session('local[2]', 2, extra={'spark.checkpoint.dir': sys.argv[3]});"
            "start_catalog_stream(s, sys.argv[1], sys.argv[2]).awaitTermination(120); s.stop()")
    where = os.path.join(root, "dir=" + quote(BASE + "/SIHSUS/200801_/Dados", safe=""))
    os.makedirs(where)
    for k, name in enumerate(["RDPE0901.dbc", "RDTO0902.dbc"]):
        with open(os.path.join(where, f"part-{k}.txt"), "w", encoding="latin-1") as f:
            f.write(f"10-15-09  01:05PM   1234 {name}\n")
        env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
        subprocess.run([sys.executable, "-c", code, root, sink, os.path.join(tmpdir_fresh, "shared")], check=True, env=env, timeout=240)
    from arquivo.sources.store import read_catalog
    assert sorted(r.uf for r in read_catalog(spark, sink).collect()) == ["pe", "to"]
