"""Date keys, look-back windows and the percent format of the report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(col: Column) -> Column:
    """Date -> YYYYMMDD as an integer (arithmetic, so it stays inside generated code)."""
    d = col.cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def key_date(col: Column) -> Column:
    """YYYYMMDD -> date, null if there is no such day."""
    text = F.lpad(col.cast("string"), 8, "0")
    return F.try_to_date(text, "yyyyMMdd")


def key_of(day: dt.date) -> int:
    """The key of a literal date: lets a date window become a range over the stored key."""
    return day.year * 10000 + day.month * 100 + day.day


def percent(col: Column) -> Column:
    """Share -> percent with one decimal, rounded half up in decimal arithmetic."""
    return F.round((col * 100).cast("decimal(18,4)"), 1)
