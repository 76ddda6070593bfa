"""Date keys (integer yyyyMMdd), inclusive spans and month buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_key(key: Column) -> Column:
    """Date of an integer yyyyMMdd key; null, not an error, where it names no calendar day."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def key_from_date(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def inclusive_days(start: str, end: str) -> Column:
    return F.datediff(end, start) + 1


def whole_weeks(start: str, end: str) -> Column:
    """Weeks between two dates, the end day not counted, cut towards zero."""
    return (F.datediff(end, start) / 7).cast("int")


def month_of_key(key: Column, first: Column, last: Column) -> Column:
    """Running number of a date key's month, keys outside ``first..last`` moved to its ends.

    Monotone in the key: whenever ``a <= t <= b``, the month of ``t`` lies between those of
    ``a`` and ``b``. A join on it therefore loses no match, whatever range is given.
    """
    year_month = F.floor(F.least(F.greatest(key, first), last) / 100)
    return (F.floor(year_month / 100) * 12 + year_month % 100).cast("int")


def month_of_date(day: Column, first: Column, last: Column) -> Column:
    """The same number for a date, with the same bounds as dates."""
    inside = F.least(F.greatest(day, first), last)
    return F.year(inside) * 12 + F.month(inside)
