"""Calendar attributes of a timestamp, all JVM-side and zone-free on wall-clock input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_flags(date: Column) -> dict[str, Column]:
    """Attributes that depend on the date alone."""
    name = F.dayname(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": name,
        "is_weekend": name.isin("Sat", "Sun").cast("tinyint"),
    }


def calendar(ts: Column) -> dict[str, Column]:
    """Date, year, month, day, hour, minute, short weekday name and 0/1 weekend flag."""
    date = ts.cast("date")
    days = day_flags(date)
    return {
        "date": date,
        "year": days["year"],
        "month": days["month"],
        "day": days["day"],
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "day_of_week": days["day_of_week"],
        "is_weekend": days["is_weekend"],
    }


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)
