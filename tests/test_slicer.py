"""Time and region slicing (F1-F3) over one small table of files."""

import pytest

from arquivo.operators.slicer import Slicer, region_predicate, time_predicate

FILES = {"m0": ("pe", 2007, 3), "m1": ("pe", 2007, 11), "m2": ("df", 2009, 3), "y0": ("df", 2007, None), "y1": (None, 2010, None),
         "u0": (None, None, None), "u1": ("to", None, None)}


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([(k, *v) for k, v in FILES.items()], "k string, uf string, year int, month int").cache()


def kept(files, predicate):
    return {r.k for r in files.filter(predicate).collect()}


def test_without_bounds_everything_passes(files):
    assert kept(files, time_predicate()) == kept(files, region_predicate([])) == kept(files, Slicer().predicate()) == set(FILES)


@pytest.mark.parametrize("start,end,expected", [
    ("200703", "", {"m0", "m1", "m2", "y1"}),          # a yearly file sorts before its months
    ("", "200710", {"m0", "y0", "u0", "u1"}),          # undated files sort first
    ("200704", "200912", {"m1", "m2"}),
    ("2007", "2009", {"m0", "m1", "y0"}),              # a month of the end year sorts after the year
    ("2007-05", "", {"m0", "m1", "m2", "y1"}),         # a hyphen sorts before digits
    ("", "2009-12", {"m0", "m1", "y0", "u0", "u1"}),
    ("200903", "200903", {"m2"}),
])
def test_lexicographic_bounds(files, start, end, expected):
    assert kept(files, time_predicate(start, end)) == expected


@pytest.mark.parametrize("start,end,expected", [
    ("2007-05", "", {"m1", "m2", "y0", "y1"}), ("", "2007-05", {"m0", "y0"}), ("2008", "2009", {"m2"}),
    ("2007", "2007", {"m0", "m1", "y0"}), ("201007", "201007", {"y1"}),
])
def test_calendar_bounds(files, start, end, expected):
    assert kept(files, time_predicate(start, end, mode="calendar")) == expected


def test_bad_bounds_and_modes():
    for start, mode in (("07-1", "calendar"), ("200701", "other")):
        with pytest.raises(ValueError):
            time_predicate(start=start, mode=mode)


def test_regions_are_never_null(files):
    chosen = region_predicate(["pe", "to"])
    assert kept(files, chosen) == {"m0", "m1", "u1"}
    assert kept(files, ~chosen) == set(FILES) - {"m0", "m1", "u1"}


def test_conjunction(files):
    assert kept(files, Slicer(start="200701", regions=["df"]).predicate()) == {"m2"}
    assert kept(files, Slicer(end="2009", regions=["to", "df"]).predicate()) == {"y0", "u1"}
