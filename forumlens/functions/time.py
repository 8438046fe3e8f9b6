"""Time columns derived from `created_utc` (Unix seconds, read as UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
SECONDS_PER_YEAR = 86400 * 365


def created_ts(created: str = "created_utc") -> Column:
    return F.timestamp_seconds(F.col(created))


def created_date(created: str = "created_utc") -> Column:
    return F.to_date(created_ts(created))


def year_month(created: str = "created_utc") -> Column:
    return F.date_format(created_ts(created), "yyyy-MM")


def period(grain: str = "monthly", created: str = "created_utc") -> Column:
    """Period label: `2024-03-09` (daily), `2024-03` (monthly) or `2024-Q1` (quarterly)."""
    day = created_date(created)
    if grain == "daily":
        return F.date_format(day, "yyyy-MM-dd")
    if grain == "monthly":
        return F.date_format(day, "yyyy-MM")
    if grain == "quarterly":
        return F.concat_ws("-Q", F.year(day), F.quarter(day))
    raise ValueError(f"unknown grain {grain!r}; use daily, monthly or quarterly")


def day_of_week(created: str = "created_utc") -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(created_ts(created))


def hour_of_day(created: str = "created_utc") -> Column:
    return F.hour(created_ts(created))


def is_weekend(created: str = "created_utc") -> Column:
    return day_of_week(created).isin(1, 7).cast("int")


def day_name(dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), dow)
