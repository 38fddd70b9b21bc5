"""The event stream: source, microbatch build, deduplication, sessions.

Event-time watermarks need a timestamp with time zone, so streams are cast to
one on the way in and back on the way out. Both ends use the session time zone,
which should be UTC: in a zone with daylight saving an hour of the year has no way
back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.incremental import (
    DayUpdate,
    IncrementalTable,
    full_refresh,
    merged_days,
    replace_days,
)
from tidemark.operators.sessions import GAP_SECONDS
from tidemark.plans.metrics import agg_post_metrics_daily, agg_user_metrics_daily
from tidemark.plans.staging import stg_events
from tidemark.session import together
from tidemark.sources import paths


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream; a single file is a folder of one.

    ``max_files`` bounds a microbatch, so that a large backlog is worked off in steps.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not paths.is_file(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that is there, then stop; the next call continues after it."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def build_daily_tables(
    raw_events: DataFrame,
    staged: IncrementalTable,
    posts_daily: IncrementalTable,
    users_daily: IncrementalTable,
) -> DataStreamWriter:
    """Microbatch build of the staged events and both daily tables.

    Each batch replaces its events by id and aggregates every day that changes
    again, as a whole. The staged events are written last: a batch that broke off
    is delivered again, finds them unchanged and so repeats all of its steps.
    """
    daily = ((posts_daily, agg_post_metrics_daily), (users_daily, agg_user_metrics_daily))

    def process(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        events = stg_events(batch)
        if not staged.exists(spark):
            together(spark, *(partial(full_refresh, aggregate(events), table) for table, aggregate in daily))
            full_refresh(events, staged)
            return
        with merged_days(events, staged) as update:

            def replace(table: IncrementalTable, aggregate: Callable[[DataFrame], DataFrame]) -> None:
                recomputed = aggregate(update.content)
                replace_days(DayUpdate(recomputed, update.days, update.shrinking), table)

            together(spark, *(partial(replace, *one) for one in daily))
            replace_days(update, staged)

    return raw_events.writeStream.foreachBatch(process)


def _with_event_time(events: DataFrame, ts: str, delay: dt.timedelta) -> DataFrame:
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(
        ts, f"{int(delay.total_seconds())} seconds"
    )


def deduplicated(events: DataFrame, ts: str, delay: dt.timedelta) -> DataFrame:
    """Each event once, its copies being at most ``delay`` apart in event time."""
    once = _with_event_time(events, ts, delay).dropDuplicatesWithinWatermark(["event_id"])
    return once.withColumn(ts, F.col(ts).cast("timestamp_ntz"))


def stream_sessions(
    events: DataFrame,
    key: str,
    ts: str,
    delay: dt.timedelta,
    gap_seconds: int = GAP_SECONDS,
) -> DataFrame:
    """Sessions, emitted once no more event can extend them."""
    # Each task merges the sessions of its own rows first, so a viewer with very
    # many events sends few rows over the shuffle.
    events.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    timed = _with_event_time(events, ts, delay)
    window = F.session_window(ts, f"{gap_seconds} seconds").alias("session")
    return (
        timed.groupBy(key, window)
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("events"))
        .select(
            key,
            F.col("first").cast("timestamp_ntz").alias("session_start"),
            F.col("last").cast("timestamp_ntz").alias("session_end"),
            "events",
        )
    )


def open_sessions(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """The sessions a stream of ``stream_sessions`` has not emitted yet, from its state.

    Reads what the last finished batch left in the state store, one row an open session,
    and none of the events. Emitted and open sessions together are all there are, but for
    events so late that the stream has dropped them.
    """
    state = spark.read.format("statestore").load(checkpoint)
    # The aggregates of a session, in the order of ``stream_sessions``.
    first, last, events = state.schema["value"].dataType.names[-3:]
    return state.select(
        F.col("value")[key].alias(key),
        F.col("value")[first].cast("timestamp_ntz").alias("session_start"),
        F.col("value")[last].cast("timestamp_ntz").alias("session_end"),
        F.col("value")[events].alias("events"),
    )
