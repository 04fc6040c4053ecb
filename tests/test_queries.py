"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
from arquivo.plans.catalog import QUERIES
from arquivo.plans.oracle import oracles
from arquivo.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracles())
    assert set(QUERIES) <= set(E.queries()) and set(oracles()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracles()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, rel.columns)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["dataset", "n_files", "total_bytes", "first_period", "last_period"]
    assert len(rows) == 11
    assert sum(r.n_files for r in rows) == 1437
    assert sum(r.total_bytes for r in rows) == 356461151
    assert [r.dataset for r in rows] == sorted(r.dataset for r in rows)
