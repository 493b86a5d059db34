"""Calendar attributes computed from the value itself (no join needed for date/time keys)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.parse import ColumnOrName, _c


def date_key(c: ColumnOrName) -> Column:
    """``yyyyMMdd`` as int, e.g. 2016-01-01 -> 20160101 (null stays null)."""
    x = _c(c)
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")


def date_parts(d: ColumnOrName) -> dict[str, Column]:
    """The calendar attributes of a date: key, year, month, English month name, quarter,
    day of month, English weekday name, weekend flag (Saturday or Sunday)."""
    x = _c(d)
    return {
        "date_key": date_key(x),
        "year": F.year(x),
        "month": F.month(x),
        "month_name": F.date_format(x, "MMMM"),
        "quarter": F.quarter(x),
        "day": F.dayofmonth(x),
        "day_of_week": F.date_format(x, "EEEE"),
        # dayofweek: 1 = Sunday ... 7 = Saturday
        "is_weekend": F.dayofweek(x).isin(1, 7),
    }
