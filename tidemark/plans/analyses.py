"""Analyst queries over facts and history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import in_year, month_start
from tidemark.operators.distinct import bitmaps, distinct_counts
from tidemark.operators.skew import ROWS_PER_GROUP
from tidemark.operators.temporal import temporal_join
from tidemark.plans.metrics import with_day_end
from tidemark.schemas import VALID_FROM, VALID_TO, timestamp


def _of_year(facts: DataFrame, ts: str, day: str, year: int) -> DataFrame:
    # The day prunes partitions; the time range also prunes files of a table that
    # is not partitioned.
    starts, ends = timestamp(f"{year:04d}-01-01"), timestamp(f"{year + 1:04d}-01-01")
    return facts.where(in_year(day, year) & (F.col(ts) >= starts) & (F.col(ts) < ends))


def _valid_in_year(versions: DataFrame, year: int) -> DataFrame:
    starts, ends = timestamp(f"{year:04d}-01-01"), timestamp(f"{year + 1:04d}-01-01")
    return versions.where((F.col(VALID_FROM) < ends) & (F.col(VALID_TO) > starts))


def _mau(joined: DataFrame, ts: str) -> DataFrame:
    per_group = joined.groupBy(month_start(F.col(ts)).alias("activity_month"), "region").agg(
        F.count_distinct("user_id").alias("mau")
    )
    return per_group.orderBy(F.desc("activity_month"), F.desc("mau"), "region")


def mau_by_region_and_month(
    fct_events: DataFrame,
    user_versions: DataFrame,
    year: int,
    method: str = "auto",
    rows_per_group: int | None = ROWS_PER_GROUP,
) -> DataFrame:
    """Monthly active users by the region they were in at the time of each event.

    A NULL region collects events that no version covers. A user who moves within
    a month counts in each region.
    """
    events = _of_year(fct_events, "created_at", "partition_date", year)
    joined = temporal_join(
        # The id spreads events of one instant; unless a user is hot, it is not read.
        events.select("user_id", "created_at", "event_id"),
        _valid_in_year(user_versions, year),
        "user_id",
        "created_at",
        ["region"],
        method,
        rows_per_group,
    )
    return _mau(joined, "created_at")


def mau_from_daily(
    agg_user: DataFrame,
    user_versions: DataFrame,
    year: int,
    method: str = "auto",
    rows_per_group: int | None = ROWS_PER_GROUP,
) -> DataFrame:
    """The same from the daily table, with the region held at the end of each day.

    Much smaller input; differs where a user moves between two events of a day.
    """
    days = with_day_end(agg_user.where(in_year("event_date", year)), "day_end")
    joined = temporal_join(
        days.select("user_id", "day_end"),
        _valid_in_year(user_versions, year),
        "user_id",
        "day_end",
        ["region"],
        method,
        rows_per_group,
    )
    return _mau(joined, "day_end")


def active_users_daily(
    fct_events: DataFrame,
    user_versions: DataFrame,
    method: str = "auto",
    rows_per_group: int | None = ROWS_PER_GROUP,
) -> DataFrame:
    """The set of active users of each day and region, to be stored and merged.

    Each day follows from its own events, so only days that change are computed again.
    """
    joined = temporal_join(
        fct_events.select("user_id", "created_at", "event_id", "partition_date"),
        user_versions,
        "user_id",
        "created_at",
        ["region"],
        method,
        rows_per_group,
    )
    return bitmaps(
        joined.withColumnRenamed("partition_date", "activity_date"), ["activity_date", "region"], "user_id"
    )


def active_users_by(daily: DataFrame, period: str, year: int | None = None) -> DataFrame:
    """Distinct users per ``period`` (week, month, quarter, year) and region, from the sets of
    their days. Equals a distinct count over the events."""
    days = daily if year is None else daily.where(in_year("activity_date", year))
    starts = F.to_date(F.date_trunc(period, "activity_date")).alias("starts")
    return distinct_counts(days, [starts, "region"], "users")


def creators_at_post_time(
    posts: DataFrame,
    user_versions: DataFrame,
    attributes: list[str],
    method: str = "auto",
    rows_per_group: int | None = ROWS_PER_GROUP,
) -> DataFrame:
    """Posts with their creator's attributes as they were when the post was made."""
    versions = user_versions.withColumnRenamed("user_id", "creator_id")
    return temporal_join(
        posts, versions, "creator_id", "created_at", attributes, method, rows_per_group
    )
