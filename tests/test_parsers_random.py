"""Parsers on lines and names that are built from known fields."""

import datetime as dt
import random

from arquivo.operators.listing import listing_files, listing_rejects, parse_listing
from arquivo.operators.store import most_recent, parse_store_names, valid_store_files, version_positions


def test_listing_lines_give_back_their_fields(spark):
    rnd = random.Random(31)
    lines, fields, bad = [], {}, set()
    for i in range(1500):
        when = dt.datetime(rnd.randint(1969, 2068), rnd.randint(1, 12), rnd.randint(1, 28), rnd.randint(0, 23), rnd.randint(0, 59))
        clock = when.strftime("%I:%M%p") if rnd.random() < .7 else when.strftime("%I:%M%p").lower()
        day = when.strftime("%m-%d-%y")
        if rnd.random() < .2:  # without leading zeros
            day, clock = f"{when.month}-{when.day}-{when:%y}", clock.lstrip("0")
        stem, ext = rnd.choice(["plain", "with space", "dots.in.it", "ação"]), rnd.choice(["dbc", "ZIP", ""])
        name = f"{stem}.{ext}" if ext or "." in stem else stem
        size = rnd.choice([0, 7, 10**10])
        text, size_is = rnd.choice([(str(size), size), ("unknown", 0)])
        gap = rnd.choice([" ", "\t", "    "])
        kind = rnd.randrange(12)
        if kind == 0:
            bad.add(i)
            line = rnd.choice([day, f"{day}{gap}{clock}", f"{day}{gap}{clock}{gap}{text}", f"99-{day}{gap}{clock} {text} {name}", ""])
        else:
            line = f"{rnd.choice(['', '  '])}{day}{gap}{clock}{gap}{text}{gap}{name}"
            fields[i] = (name, when, size_is, name.rsplit(".", 1)[1].lower() if "." in name else None)
        lines.append((i, "/d", line))
    parsed = parse_listing(spark.createDataFrame(lines, "id int, dir string, line string"))
    got = {r.id: (r.filename, r.datetime, r.size, r.extension) for r in listing_files(parsed).collect()}
    assert got == fields
    assert {r.id for r in listing_rejects(parsed).select("id").collect()} == bad


def store_names(seed, n):
    """{name: (dataset, partition, date, extension) or None if it cannot be parsed}."""
    rnd, out = random.Random(seed), {}
    for _ in range(n):
        dataset, partition = rnd.choice(["po", "cnes-lt", "po-preliminar"]), rnd.choice(["", "201212-pe", "1987", "a_b", "x@y"])
        date = dt.date(rnd.randint(1990, 2040), rnd.randint(1, 12), rnd.randint(1, 28))
        base, ext = f"{dataset}_{partition}" if partition else dataset, rnd.choice([".dbc", ".zip", ""])
        kind = rnd.randrange(10)
        if kind == 0:
            stamp = rnd.choice([f"{date:%Y%m}", f"{date:%Y%m%d}0", f"{date:%Y}0230", "2020011x"])
            out[f"{base}@{stamp}{ext}"] = None
        elif kind == 1 and "@" not in partition:
            out[f"{base}-{date:%Y%m%d}{ext}"] = None
        else:
            out[f"{base}@{date:%Y%m%d}{ext}"] = (dataset, partition, date, ext)
    return out


def test_store_names_give_back_their_fields(spark):
    names = store_names(8, 1200)
    df = spark.createDataFrame([("d", n, 1) for n in names], "dir string, name string, size bigint")
    rows = parse_store_names(df).collect()
    assert {r.name: (r.dataset, r.partition, r.date, r.extension) if r.valid else None for r in rows} == names


def test_versions_are_counted_by_name(spark):
    names = {n: v for n, v in store_names(9, 900).items() if v}
    rows = [(d, n, 1) for i, n in enumerate(names) for d in (["one", "two"] if i % 3 else ["one"])]
    files = valid_store_files(parse_store_names(spark.createDataFrame(rows, "dir string, name string, size bigint")))
    latest = {(r.dir, r.name) for r in most_recent(files).where("is_most_recent").collect()}
    place = {(r.dir, r.name): (r.position, r.n) for r in version_positions(files).collect()}
    assert len(place) == len(rows)
    for d, n, _ in rows:
        peers = [m for e, m, _ in rows if e == d and names[m][1] == names[n][1]]
        assert place[d, n] == (sum(m <= n for m in peers), len(peers))
        assert ((d, n) in latest) == (place[d, n][0] == len(peers))
