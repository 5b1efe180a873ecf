"""Calendar expressions on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "MM").cast("date")


def month_index(c: Column | str) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(_col(c)) * 12 + F.month(_col(c))


def months_diff(later: Column | str, earlier: Column | str, floor: int | None = None) -> Column:
    """Calendar-month difference, optionally not below ``floor``."""
    gap = month_index(later) - month_index(earlier)
    if floor is None:
        return gap
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(floor)))


def next_month(c: Column | str) -> Column:
    return F.add_months(month_start(c), 1)


def date_key(c: Column | str) -> Column:
    d = _col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_key(c: Column | str) -> Column:
    d = _col(c)
    return F.year(d) * 100 + F.month(d)


def dow_sun1(c: Column | str) -> Column:
    """Sunday = 1."""
    return F.dayofweek(_col(c))


def dow_mon1(c: Column | str) -> Column:
    """Monday = 1."""
    return F.weekday(_col(c)) + 1


def us_week(c: Column | str) -> Column:
    """Week 1 holds January 1 and weeks start on Sunday."""
    d = _col(c)
    offset = F.dayofweek(F.trunc(d, "YEAR")) - 2
    return (F.floor((F.dayofyear(d) + offset) / 7) + 1).cast("int")


def is_weekend(c: Column | str) -> Column:
    return F.dayofweek(_col(c)).isin(1, 7)


def is_month_end(c: Column | str) -> Column:
    d = _col(c)
    return d == F.last_day(d)


def is_quarter_end(c: Column | str) -> Column:
    d = _col(c)
    return (d == F.last_day(d)) & (F.month(d) % 3 == 0)


def launch_from_year(year: Column | str) -> Column:
    """January 1 of a launch year; null when the year is missing or unusable."""
    y = _col(year).cast("string").try_cast("int")
    return F.when(y.between(1, 9999), F.make_date(y, F.lit(1), F.lit(1)))
