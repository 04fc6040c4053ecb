"""Slicing classified files by period and region.

``mode="lexicographic"`` is the reference behaviour: the file's period text
('YYYY', 'YYYYMM' or '') is compared as a string with the bounds, so hyphenated
bounds and mixed granularities compare by code point. ``mode="calendar"`` is a
derived variant: hyphens are dropped, a year bound covers its twelve months and
a yearly file covers its whole year; undated files pass only without bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arquivo.functions.columns import period_text


def time_predicate(start: str = "", end: str = "", mode: str = "lexicographic",
                   year: str = "year", month: str = "month") -> Column:
    if not start and not end:
        return F.lit(True)
    if mode == "lexicographic":
        t = period_text(year, month)
        if start and not end:
            return t >= F.lit(start)
        if end and not start:
            return t <= F.lit(end)
        return (t >= F.lit(start)) & (t <= F.lit(end))
    if mode != "calendar":
        raise ValueError(f"unknown slicing mode {mode!r}")
    y, m = F.col(year), F.col(month)
    lo = y * 100 + F.coalesce(m, F.lit(1))
    hi = y * 100 + F.coalesce(m, F.lit(12))
    cond = y.isNotNull()
    if start:
        cond = cond & (hi >= F.lit(_bound(start, first=True)))
    if end:
        cond = cond & (lo <= F.lit(_bound(end, first=False)))
    return F.coalesce(cond, F.lit(False))


def partition_time_predicate(period: Column, start: str = "", end: str = "", mode: str = "lexicographic") -> Column:
    """``time_predicate`` on a partition directory's period text ('YYYY', 'YYYYMM' or '')."""
    if mode not in ("lexicographic", "calendar"):
        raise ValueError(f"unknown slicing mode {mode!r}")
    cond = F.lit(True)
    if mode == "lexicographic":
        cond = cond & (period >= start) if start else cond
        return cond & (period <= end) if end else cond
    number = F.try_to_number(period, F.lit("999999")).cast("int")
    yearly = F.length(period) == 4
    if start:
        cond = cond & (F.when(yearly, number * 100 + 12).otherwise(number) >= _bound(start, first=True))
    if end:
        cond = cond & (F.when(yearly, number * 100 + 1).otherwise(number) <= _bound(end, first=False))
    return F.coalesce(cond, F.lit(False))


def _bound(text: str, first: bool) -> int:
    digits = text.replace("-", "")
    if not digits.isdigit() or len(digits) not in (4, 6):
        raise ValueError(f"bad period bound {text!r}: use YYYY, YYYYMM or YYYY-MM")
    if len(digits) == 4:
        return int(digits) * 100 + (1 if first else 12)
    return int(digits)


def region_predicate(regions: Sequence[str] | None, uf: str = "uf") -> Column:
    """uf in regions; no regions -> all; a null uf fails (never null itself)."""
    if not regions:
        return F.lit(True)
    return F.coalesce(F.col(uf).isin(*list(regions)), F.lit(False))


@dataclass
class Slicer:
    start: str = ""
    end: str = ""
    regions: Sequence[str] | None = field(default=None)
    mode: str = "lexicographic"

    def predicate(self) -> Column:
        return region_predicate(self.regions) & time_predicate(self.start, self.end, self.mode)

    def partition_predicate(self, period: Column) -> Column:
        """The time bounds on the period text of a stored partition; regions are not in it."""
        return partition_time_predicate(period, self.start, self.end, self.mode)

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.filter(self.predicate())
