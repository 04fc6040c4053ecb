from collections import Counter

import pytest

from arquivo.operators.classify import classify, classify_by_regex
from arquivo.sources import registry as reg


def test_counts():
    periods = [p for d in reg.DATASETS.values() for p in d.periods]
    assert len(reg.DATASETS) == 113
    assert len(periods) == 175
    assert sum(p.preliminary for p in periods) == 58
    assert Counter(p.extension for p in periods) == {"dbc": 169, "zip": 6}
    parts = Counter(d.partition for d in reg.DATASETS.values())
    assert parts[("uf", "year")] == 66
    assert parts[("uf", "yearmonth")] == 36
    assert parts[("year",)] == 9
    assert parts[("version",)] == 1 and parts[("uf",)] == 1
    assert len(reg.UF_CODES) == 28 and "BR" in reg.UF_CODES
    assert len(reg.GROUPS) == 16 and len(reg.DOCS) == 13 and len(reg.AUXILIARY) == 16


def test_registry_frames(spark):
    assert reg.registry(spark).count() == 175
    assert reg.datasets(spark).count() == 113
    assert reg.groups(spark).count() == 16
    assert reg.support_registry(spark, "doc").count() == 15
    assert reg.support_registry(spark, "aux").count() == 18


def test_pattern_is_lower_case():
    p = reg.DATASETS["sih-sp"].periods[1]
    rx = reg.period_regex(p)
    assert rx == rx.lower() and rx.startswith("^sp(") and rx.endswith("\\.dbc$")


def test_unknown_shape_raises(monkeypatch):
    bad = reg.Dataset("x", "x", "sih", ("uf",), (reg.Period("/d", "X", "nonexistent_pattern", "dbc"),))
    monkeypatch.setitem(reg.DATASETS, "x", bad)
    with pytest.raises((ValueError, AssertionError)):
        reg._check()


def _generated_names():
    """One name per period and UF (and a sample of years/months)."""
    rows = []
    for d in reg.DATASETS.values():
        for i, p in enumerate(d.periods):
            for uf in reg.UF_CODES:
                stem = {
                    "uf_year2_month": f"{uf}9701", "uf_year2_month_sia_pa": f"{uf}0801a",
                    "uf_year": f"{uf}2015", "uf_year2": f"{uf}15", "year": "2015", "year2": "15",
                    "uf_mapas_year": f"{uf.lower()}_mapas_2015", "uf_cnv": f"{uf}_cnv", "any": f"tab {uf}",
                }[p.shape]
                rows.append((f"{d.key}#{i}", p.dir, f"{p.prefix}{stem}.{p.extension.upper()}"))
    return sorted(set(rows))


def test_each_generated_name_matches_only_its_period(spark):
    rows = _generated_names()
    df = spark.createDataFrame(rows, "expect string, dir string, filename string")
    out = classify(df).select("expect", "filename", "dataset").collect()
    got = Counter((r.expect, r.filename) for r in out)
    # every name is classified exactly once, into its own dataset
    assert len(out) == len(rows)
    assert all(r.expect.split("#")[0] == r.dataset for r in out)
    assert set(got.values()) == {1}


def test_shape_join_equals_regex_join(spark):
    df = spark.createDataFrame(_generated_names(), "expect string, dir string, filename string")
    cols = ["expect", "dataset", "uf", "year", "month", "version", "preliminary", "depth"]
    a = classify(df).select(cols)
    b = classify_by_regex(df).select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
