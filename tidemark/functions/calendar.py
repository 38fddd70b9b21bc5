"""Date functions: truncations, parts and the calendar attributes of a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: str | Column) -> Column:
    return F.trunc(day, "month")


def day_start(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def next_day_start(day: Column) -> Column:
    """End of the half-open interval that covers ``day``."""
    return F.date_add(day, 1).cast("timestamp_ntz")


def hour_number(ts: Column) -> Column:
    """Hours since 1970-01-01, without a detour over the session time zone."""
    days = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
    return (days * 24 + F.hour(ts)).cast("int")


def microsecond_number(ts: Column) -> Column:
    """Microseconds since 1970-01-01, without a detour over the session time zone."""
    days = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    clock = F.hour(ts) * 60 + F.minute(ts)
    seconds = F.extract(F.lit("SECOND"), ts) * 1_000_000
    return (days * 1440 + clock) * 60_000_000 + seconds.cast("bigint")


def in_year(day: str, year: int) -> Column:
    """The days of one year as a range, which file and partition pruning can use."""
    return F.col(day).between(
        F.lit(f"{year:04d}-01-01").cast("date"), F.lit(f"{year:04d}-12-31").cast("date")
    )


def calendar_columns(day: str) -> list[Column]:
    """The eleven calendar attributes of a date column."""
    return [
        F.trunc(day, "month").alias("date_month"),
        F.trunc(day, "quarter").alias("date_quarter"),
        F.trunc(day, "year").alias("date_year"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        (F.weekday(day) + 1).alias("iso_day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]
