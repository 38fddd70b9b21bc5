"""Date spine and gap-filled daily metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.calendar import calendar_columns

_ONE_DAY = "interval 1 day"


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from ``start`` to the day before ``end``, with calendar attributes."""
    days = spark.range((end - start).days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day")
    )
    return days.select("date_day", *calendar_columns("date_day"))


def spine_of(df: DataFrame, day: str) -> DataFrame:
    """The spine from the first to the last day found in ``df``."""
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = bounds.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr(_ONE_DAY))).alias("date_day")
    )
    return days.select("date_day", *calendar_columns("date_day"))


def fill_daily_gaps(daily: DataFrame, key: str, day: str, metrics: list[str]) -> DataFrame:
    """One row for each day between a key's first and last, zeros where it had none.

    Each daily row produces the empty days up to the key's next one, so no spine
    has to be crossed with the keys. The window sorts at most one row per day. Rows
    without a day stay as they are.
    """
    # NULLs first, so that no dated row is followed by one.
    following = F.lead(day).over(Window.partitionBy(key).orderBy(F.asc_nulls_first(day)))
    until = F.date_sub(F.coalesce(following, F.date_add(day, 1)), 1)
    days = F.explode_outer(F.sequence(F.col(day), F.col("_until"), F.expr(_ONE_DAY)))
    filled = daily.withColumn("_until", until).withColumn("_day", days)
    return filled.select(
        F.col("_day").alias(day),
        key,
        *[
            F.when(F.col("_day").eqNullSafe(F.col(day)), F.col(name)).otherwise(F.lit(0)).alias(name)
            for name in metrics
        ],
    )
