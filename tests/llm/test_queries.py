"""The registered queries: against their SQL, and the pipeline against brute force."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from arquivo.llm import queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_all_are_registered():
    numbers = sorted(int(k.split("_")[0][2:]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and set(queries.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert sorted(rel.columns) == columns
    rows = sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))
    assert rows == sorted(map(str, rel.project(", ".join(columns)).fetchall()))


@pytest.mark.parametrize("name", ["op3_quality", "op6_tokens", "op7_toxicity", "op8_langid"])
def test_query_covers_the_table(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert {r.doc_id for r in df.select("doc_id").distinct().collect()} == set(range(200))


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, frame = docs.schema.simpleString(), docs
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = corpus_pipeline.common.settle(stage(spark, frame, SF), "test")
        if k == 4:
            break
        assert frame.schema.simpleString() == columns
        got = {r.doc_id: r.text for r in frame.collect()}
        assert all(r.n_chars == len(r.text) for r in frame.collect())
        if k == 0:  # the learned rules reject few, and only where symbols or the like abound
            passed = {d for d, t in rows.items() if not brute.base_failed(brute.quality_counts(t))}
            assert set(got) <= passed and len(got) >= 0.85 * len(passed)
        elif k == 1:
            assert got == brute.without_repeats(rows)
        elif k == 2:
            ids = sorted(rows)
            _, least = brute.simhash_components(ids, [rows[i] for i in ids])
            assert set(got) == set(least)
        else:
            assert set(got) == set(rows) - {d for d, *_ in brute.contaminated(rows, items)}
        rows = got
    assert {r.doc_id for r in frame.collect()} == set(rows)
    assert sorted(map(str, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(
        map(str, frame.drop("sequence_id", "offset").collect()))


def test_entry_works_without_the_subpackage(monkeypatch):
    import importlib

    for name in [m for m in sys.modules if m.startswith("arquivo.llm")] + ["corpus_pipeline"]:
        monkeypatch.setitem(sys.modules, name, None)
    import arquivo

    monkeypatch.delattr(arquivo, "llm", raising=False)
    try:
        entry = importlib.reload(E)
        assert not [k for k in entry.queries() if k.startswith("op") or k == "pipeline"]
        assert set(entry.oracle_sql()) == set(entry.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(E)
    assert "pipeline" in E.queries()
