"""Randomised check: the shape equi-join and the per-period regex join agree
on adversarial names (prefix collisions, version letters, short stems, case,
several dots, nested directories)."""

import random

from arquivo.operators.classify import classify, classify_by_regex
from arquivo.sources import registry as reg

PIECES = ["", "a", "b", "z", "sp", "SP", "rj", "br", "xx", "_cnv", "_mapas_", "0", "00", "01", "12", "13",
          "19", "2015", "99", "7", "8", ".", "..", "dbc", "zip", " ", "-"]


def _body(rnd, shape):
    uf = rnd.choice(reg.UF_CODES + ["XX", "Sp"])
    yy = f"{rnd.randint(0, 99):02d}"
    mm = rnd.choice(["01", "06", "12", "00", "13"])
    return {
        "uf_year2_month": uf + yy + mm, "uf_year2_month_sia_pa": uf + yy + mm + rnd.choice(["", "a", "b", "Z", "1"]),
        "uf_year": uf + str(rnd.randint(1990, 2030)), "uf_year2": uf + yy, "year": str(rnd.randint(1990, 2030)),
        "year2": yy, "uf_mapas_year": uf.lower() + "_mapas_" + str(rnd.randint(2000, 2030)),
        "uf_cnv": uf + "_cnv", "any": rnd.choice(["tab 1", "x", "a.b"]),
    }[shape]


def _mutate(rnd, stem):
    k = rnd.random()
    if k < 0.5 or not stem:
        return stem
    i = rnd.randrange(len(stem))
    if k < 0.65:
        return stem[:i] + stem[i + 1:]                       # drop a character
    if k < 0.8:
        return stem[:i] + rnd.choice(PIECES) + stem[i:]      # insert a piece
    if k < 0.9:
        return stem.swapcase()
    return stem + rnd.choice(PIECES)


def _names(rnd, n):
    periods = [p for d in reg.DATASETS.values() for p in d.periods]
    rows = []
    for i in range(n):
        p = rnd.choice(periods)
        q = rnd.choice(periods) if rnd.random() < 0.2 else p   # sometimes another period's shape
        stem = _mutate(rnd, rnd.choice([p.prefix, p.prefix.lower()]) + _body(rnd, q.shape))
        ext = rnd.choice([p.extension, p.extension, p.extension.upper(), "dbc", "zip", "txt", ""])
        name = stem + ("." + ext if ext else "")
        d = p.dir + rnd.choice(["", "", "", "/x", "/x/y", "/x/y/z", "/x/y/z/w", "/"])
        rows.append((i, d, name))
    return rows


def test_equi_join_equals_regex_join(spark):
    rnd = random.Random(20261202)
    df = spark.createDataFrame(_names(rnd, 6000), "id int, dir string, filename string")
    cols = ["id", "dataset", "uf", "year", "month", "version", "preliminary", "depth"]
    a = classify(df).select(cols)
    b = classify_by_regex(df).select(cols)
    assert a.count() > 1000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _brute_force(rows, max_depth=3):
    """Per period: the file's directory is the period directory or up to
    ``max_depth`` levels below it, and Python's ``re`` matches the lower-cased
    name against the period pattern (the original matching rule)."""
    import re
    out = set()
    for i, d, name in rows:
        dn = re.sub("/+", "/", d)
        dn = dn[:-1] if len(dn) > 1 and dn.endswith("/") else dn
        for ds in reg.DATASETS.values():
            for p in ds.periods:
                if dn == p.dir:
                    depth = 0
                elif dn.startswith(p.dir + "/"):
                    depth = dn[len(p.dir):].count("/")
                else:
                    continue
                if depth <= max_depth and re.match(reg.period_regex(p), name.lower()):
                    out.add((i, ds.key, depth))
    return out


def test_matches_python_re_brute_force(spark):
    rows = _names(random.Random(7), 3000)
    df = spark.createDataFrame(rows, "id int, dir string, filename string")
    got = {(r.id, r.dataset, r.depth) for r in classify(df).select("id", "dataset", "depth").collect()}
    assert got == _brute_force(rows)
