"""Remote file names: every period of the registry takes the names built for it."""

import random

import pytest

from arquivo.operators.classify import classify
from arquivo.sources import registry as reg
from arquivo.sources.registry import BASE

UFS = [c.lower() for c in reg.UF_CODES]


def build(shape, rnd):
    """The varying part of a name of a shape, and its (uf, year, month, version)."""
    uf, year, month = rnd.choice(UFS), rnd.randint(1970, 2069), rnd.randint(1, 12)
    yy = f"{year % 100:02d}"
    return {
        "uf_year2_month": (f"{uf}{yy}{month:02d}", (uf, year, month, None)),
        "uf_year2_month_sia_pa": (f"{uf}{yy}{month:02d}b", (uf, year, month, "b")),
        "uf_year": (f"{uf}{year}", (uf, year, None, None)),
        "uf_year2": (f"{uf}{yy}", (uf, year, None, None)),
        "year": (f"{year}", (None, year, None, None)),
        "year2": (yy, (None, year, None, None)),
        "uf_mapas_year": (f"{uf}_mapas_{year}", (uf, year, None, None)),
        "uf_cnv": (f"{uf}_cnv", (uf, None, None, None)),
        "any": ("some table 3", (None, None, None, "some table 3")),
    }[shape]


def test_every_period_takes_its_names(spark):
    rnd, rows, wanted = random.Random(17), [], {}
    for d in reg.DATASETS.values():
        for p in d.periods:
            i = len(rows)
            body, fields = build(p.shape, rnd)
            name = f"{p.prefix}{body}.{p.extension}"
            rows.append((i, p.dir, name.upper() if i % 2 else name))
            wanted[i] = (d.key, p.preliminary, *fields)
    got = {}
    for r in classify(spark.createDataFrame(rows, "i int, dir string, filename string")).collect():
        got.setdefault(r.i, set()).add((r.dataset, r.preliminary, r.uf, r.year, r.month, r.version))
    assert all(wanted[i] in got.get(i, ()) for i in wanted)


def one(spark, directory, name):
    return classify(spark.createDataFrame([(directory, name)], "dir string, filename string")).collect()


@pytest.mark.parametrize("name", ["RDPE0700.dbc", "RDPE0713.dbc", "RDXX0707.dbc", "RDPE0707.zip", "RDPE0707", "PE0707.dbc",
                                  "RDPE0707x.dbc", "XRDPE0707.dbc"])
def test_names_that_no_period_takes(spark, name):
    assert one(spark, BASE + "/SIHSUS/200801_/Dados", name) == []


@pytest.mark.parametrize("yy,year", [("69", 2069), ("70", 1970), ("99", 1999), ("00", 2000)])
def test_century(spark, yy, year):
    assert [r.year for r in one(spark, BASE + "/SIHSUS/200801_/Dados", f"RDTO{yy}08.dbc")] == [year]


def test_levels_below_a_directory(spark):
    for below, rows in (("", 1), ("/a", 1), ("/a/b", 1), ("/a/b/c", 1), ("/a/b/c/d", 0)):
        found = one(spark, "/territorio/tabelas" + below, "Lista 4.zip")
        assert [(r.dataset, r.version, r.depth) for r in found] == [("base-territorial", "lista 4", below.count("/"))] * rows
