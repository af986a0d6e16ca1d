"""Calendar helpers: date keys, month labels, period indexes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(ts: Column | str) -> Column:
    """``yyyyMMdd`` of the event date as an int surrogate key, computed with
    integer arithmetic (no per-row string formatting and parsing)."""
    d = F.to_date(_col(ts))
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def year_month(year: Column | str = "year", month: Column | str = "month") -> Column:
    """``2010-03`` style label."""
    return F.concat(_col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0"))


def period_index(year: Column | str = "year", month: Column | str = "month") -> Column:
    """Months since year 0: consecutive months differ by exactly 1."""
    return _col(year) * 12 + _col(month)


def is_weekend(d: Column | str) -> Column:
    # dayofweek: Sunday = 1 ... Saturday = 7
    return F.dayofweek(_col(d)).isin(1, 7)


def in_months(start: str | None = None, end: str | None = None,
              year: Column | str = "year", month: Column | str = "month") -> Column:
    """Rows whose (year, month) lies in ``[start, end]`` (``"YYYY-MM"``,
    either side open).  On a table stored partitioned by year and month the
    predicate only touches partition columns, so Spark prunes whole
    directories before reading any file."""
    key = _col(year) * 100 + _col(month)
    cond = F.lit(True)
    if start:
        y, m = (int(x) for x in start.split("-"))
        cond = cond & (key >= y * 100 + m)
    if end:
        y, m = (int(x) for x in end.split("-"))
        cond = cond & (key <= y * 100 + m)
    return cond
