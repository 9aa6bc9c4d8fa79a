"""Calendar helpers that count boundaries crossed, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(value: Column | str) -> Column:
    return F.trunc(F.to_date(value), "MM")


def week_start(value: Column | str) -> Column:
    """Sunday on or before the date."""
    day = F.to_date(value)
    return F.date_sub(day, F.dayofweek(day) - 1)


def is_weekend(value: Column | str) -> Column:
    return F.dayofweek(F.to_date(value)).isin(1, 7)


def months_between_starts(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def minute_index(value: Column | str) -> Column:
    """Minutes since 1970-01-01 with seconds dropped; differences count minute boundaries."""
    days = F.datediff(F.to_date(value), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(value) * 60 + F.minute(value)


def daypart(value: Column | str) -> Column:
    hour = F.hour(value)
    return (
        F.when(hour.between(5, 11), "Morning")
        .when(hour.between(12, 16), "Afternoon")
        .when(hour.between(17, 21), "Evening")
        .otherwise("Late Night")
    )
