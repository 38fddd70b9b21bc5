"""Viewer sessions in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GAP_SECONDS = 1800


def viewer_sessions(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "created_at",
    gap_seconds: int = GAP_SECONDS,
) -> DataFrame:
    """``(key, session_start, session_end, events)``; a longer pause starts a new session.

    Events are first combined into slots as wide as the gap: two events of one slot
    always share a session. That step shrinks before its shuffle, and what the
    window then sorts per viewer is one row per slot, bounded by the time span and
    not by the number of events.
    """
    seconds = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast(
        "bigint"
    ) * 86400 + (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))
    slots = (
        events.groupBy(key, F.floor(seconds / gap_seconds).alias("_slot"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count("*").alias("_n"))
    )
    in_order = Window.partitionBy(key).orderBy("_slot")
    pause = F.col("_first") - F.lag("_last").over(in_order)
    limit = F.make_dt_interval(secs=F.lit(gap_seconds))
    numbered = slots.withColumn(
        "_starts", F.when(pause <= limit, 0).otherwise(1)
    ).withColumn("_session", F.sum("_starts").over(in_order))
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            F.sum("_n").alias("events"),
        )
        .drop("_session")
    )
