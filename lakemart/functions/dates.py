"""Calendar attributes and day differences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86400.0


def is_weekend(day: str | Column) -> Column:
    """Saturday or Sunday (``dayofweek`` counts from Sunday = 1)."""
    return F.dayofweek(day).isin(1, 7)


def calendar_columns(day: str) -> dict[str, Column]:
    """The attributes of a date dimension row."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_of_week": F.date_format(day, "EEEE"),
        "is_weekend": is_weekend(day),
    }


def calendar_days(start: str, end: str) -> Column:
    """Midnights crossed between two times: 23:00 to 01:00 the next day is 1."""
    return F.datediff(end, start).cast("bigint")


def elapsed_days(start: str, end: str) -> Column:
    """Whole 24-hour periods between two times, rounded down also for negative spans."""
    seconds = F.timestamp_diff("SECOND", F.col(start), F.col(end))
    return F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("bigint")


def iso_month(day: str | Column) -> Column:
    """``yyyy-MM``; the ISO text of a date starts with it."""
    return F.substring((F.col(day) if isinstance(day, str) else day).cast("string"), 1, 7)


def iso_week(day: str) -> Column:
    return F.weekofyear(day)


def iso_year(day: str) -> Column:
    """The year an ISO week belongs to: 2017-01-01 is in 2016."""
    return F.extract(F.lit("yearofweek"), F.col(day))
