"""Every operator as a query over the given tables.

Dates and times leave as text, so that no client has to agree on their types, and
the open end of a version leaves as NULL next to ``is_current``.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import changes, incremental, intervals, quality, snapshots, spine
from tidemark.operators.incremental import IncrementalTable
from tidemark.operators.sampling import random_live_rows
from tidemark.operators.sessions import viewer_sessions
from tidemark.operators.skew import spread_left_join
from tidemark.plans import analyses, dimensions, intermediate, metrics, staging
from tidemark.plans.build import (
    Warehouse,
    build,
    history,
    ingest_day,
    job_date,
    keep_history,
    publish_views,
)
from tidemark.schemas import (
    IS_DELETED,
    SCD_ID,
    UPDATED_AT,
    VALID_FROM,
    VALID_TO,
    open_end,
    timestamp,
)
from tidemark.session import working_folder
from tidemark.sources import adapter
from tidemark.sources.keyed import APPLIED_ON, KeyedTable
from tidemark.sources.tables import (
    bucket_count,
    read_countries,
    read_history,
    read_table,
    write_bucketed,
    write_table,
)
from tidemark.streaming import events as streams
from tidemark.streaming.history import StreamedHistory, keep_streamed_history

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

YEAR = 2024
RUN_DAYS = 1
ACTIVE_DAYS = 3
SAMPLE_ROWS = 25
SAMPLE_SEED = 7
LOOKBACK = dt.timedelta(days=2)
STREAM_DELAY = dt.timedelta(hours=1)
INGEST_DATE = dt.date(2024, 2, 1)
FIRST_RUN, SECOND_RUN = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def as_text(df: DataFrame) -> DataFrame:
    patterns = {
        T.DateType: "yyyy-MM-dd",
        T.TimestampNTZType: "yyyy-MM-dd HH:mm:ss.SSSSSS",
    }
    return df.select(
        *[
            F.date_format(f.name, patterns[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in patterns
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return as_text(function(spark, folder))

    run.__doc__ = function.__doc__
    _QUERIES[function.__name__] = run
    return function


def _versions_out(versions: DataFrame, *columns: str) -> DataFrame:
    is_open = F.col(VALID_TO) == open_end()
    return versions.select(
        *columns,
        F.col(VALID_FROM).alias("valid_from"),
        F.when(~is_open, F.col(VALID_TO)).alias("valid_to"),
        is_open.alias("is_current"),
    )


# --- layers ------------------------------------------------------------------


@_query
def stg_users(spark, folder):
    return staging.stg_users(adapter.users(spark, folder))


@_query
def stg_posts(spark, folder):
    return staging.stg_posts(adapter.posts(spark, folder))


@_query
def stg_events(spark, folder):
    return staging.stg_events(adapter.events(spark, folder))


@_query
def int_users(spark, folder):
    return intermediate.int_users(stg_users(spark, folder), adapter.countries(spark, folder))


@_query
def int_posts(spark, folder):
    return intermediate.int_posts(stg_posts(spark, folder), int_users(spark, folder))


@_query
def fct_events(spark, folder):
    return dimensions.fct_events(intermediate.int_events(stg_events(spark, folder)))


@_query
def agg_post_daily(spark, folder):
    return metrics.agg_post_metrics_daily(stg_events(spark, folder))


@_query
def agg_user_daily(spark, folder):
    return metrics.agg_user_metrics_daily(stg_events(spark, folder))


@_query
def agg_user_daily_distinct(spark, folder):
    return metrics.agg_user_metrics_daily_distinct(stg_events(spark, folder))


@_query
def dim_posts(spark, folder):
    return dimensions.dim_posts(int_posts(spark, folder), agg_post_daily(spark, folder))


@_query
def dim_users(spark, folder):
    return dimensions.dim_users(
        int_users(spark, folder), agg_user_daily(spark, folder), dim_posts(spark, folder)
    )


def _two_builds(spark: SparkSession, folder: str) -> Warehouse:
    """All layers built twice: to the middle day, then with all events and changed users."""
    warehouse = Warehouse(working_folder(spark))
    event, middle = adapter.events(spark, folder), _middle_day(spark, folder)
    first = event.where(F.to_date("created_at") <= F.lit(middle))
    changed = _merged_users(spark, folder).drop(changes.APPLIED)
    post, countries = adapter.posts(spark, folder), adapter.countries(spark, folder)
    for run_ts, user, batch in (
        (FIRST_RUN, adapter.users(spark, folder), first),
        (SECOND_RUN, changed, event),
    ):
        build(spark, warehouse, user, post, batch, countries, run_ts)
    return warehouse


@_query
def daily_build(spark, folder):
    """Users after two builds."""
    warehouse = _two_builds(spark, folder)
    return read_table(spark, warehouse.path("analytics", "dim_users"))


@_query
def daily_build_history(spark, folder):
    """History of the users after two builds, deletion records included."""
    warehouse = _two_builds(spark, folder)
    users = read_table(spark, warehouse.path("analytics", "dim_users"))
    versions = history(warehouse, "analytics", "dim_users_snapshots", users, record=True)
    return _versions_out(
        versions, "user_id", "country", "region", F.col(IS_DELETED).alias("is_deleted")
    )


# --- history -----------------------------------------------------------------


def _history(spark: SparkSession, folder: str) -> DataFrame:
    feed = adapter.user_changes(spark, folder)
    return intervals.history_from_feed(feed, "user_id", "updated_at", "change_id")


@_query
def scd2_history(spark, folder):
    return _versions_out(_history(spark, folder), "user_id", "region", SCD_ID, UPDATED_AT)


@_query
def scd2_first_run(spark, folder):
    """First snapshot of the current posts: one open version each."""
    source = dim_posts(spark, folder).select("post_id", "creator_id", "updated_at")
    first = snapshots.snapshot_run(None, source, "post_id", "updated_at")
    return _versions_out(first, "post_id", "creator_id", SCD_ID)


@_query
def raw_user_snapshots(spark, folder):
    """History of the raw users before and after the change batch."""
    before = adapter.users(spark, folder)
    after = _merged_users(spark, folder).drop(changes.APPLIED)
    first = snapshots.snapshot_run(None, before, "user_id", "updated_at")
    versions = snapshots.snapshot_run(first, after, "user_id", "updated_at")
    return _versions_out(versions, "user_id", "country_code", "favorite_color", "deleted_at")


def _stored_runs(spark: SparkSession, key: str, *sources: DataFrame, **options) -> DataFrame:
    """The history of snapshot runs over the source as it is each time."""
    path = f"{working_folder(spark)}/history"
    for source in sources:
        keep_history(source, path, key, **options)
    return read_history(spark, path, snapshots.history_schema(sources[0]))


def _edited_posts(posts: DataFrame) -> DataFrame:
    """Every fifth post a day later, with another text; the rest as they are."""
    edited = F.col("post_id") % 5 == 0
    later = F.col("updated_at") + F.expr("interval 1 day")
    return posts.withColumns(
        {
            "post_text": F.when(edited, F.concat("post_text", F.lit(" (edited)"))).otherwise(F.col("post_text")),
            "updated_at": F.when(edited, later).otherwise(F.col("updated_at")),
        }
    )


@_query
def raw_post_snapshots(spark, folder):
    """History of the raw posts before and after an edit."""
    posts = adapter.posts(spark, folder)
    versions = _stored_runs(spark, "post_id", posts, _edited_posts(posts))
    return _versions_out(versions, "post_id", "post_text")


@_query
def dim_posts_snapshots(spark, folder):
    """History of the post dimension over two runs; metrics are as of the opening."""
    posts, users = adapter.posts(spark, folder), int_users(spark, folder)
    events, middle = stg_events(spark, folder), _middle_day(spark, folder)
    early = metrics.agg_post_metrics_daily(events.where(F.col("partition_date") <= F.lit(middle)))
    runs = [
        dimensions.dim_posts(intermediate.int_posts(staging.stg_posts(state), users), daily)
        for state, daily in ((posts, early), (_edited_posts(posts), agg_post_daily(spark, folder)))
    ]
    versions = _stored_runs(spark, "post_id", *runs)
    return _versions_out(versions, "post_id", "post_text", "creator_region", "likes", "views")


@_query
def scd2_initial_runs(spark, folder):
    """First versions begin at the creation; runs over an unchanged source add nothing."""
    users = adapter.users(spark, folder).select("user_id", "country_code", "created_at", "updated_at")
    versions = _stored_runs(
        spark, "user_id", users, users, users, initial_valid_from="created_at"
    )
    return _versions_out(versions, "user_id", "country_code", SCD_ID)


def _run_times(feed: DataFrame) -> Iterator[dt.datetime]:
    """The ends of consecutive spans of RUN_DAYS days that cover the feed."""
    first, last = feed.agg(
        F.to_date(F.min("updated_at")), F.to_date(F.max("updated_at"))
    ).first()
    day = first
    while day <= last:
        day += dt.timedelta(days=RUN_DAYS)
        yield dt.datetime.combine(day, dt.time())


def _snapshot_runs(feed: DataFrame, live: str, **options) -> DataFrame:
    """Snapshots of the state at each run time; ``live`` says which rows exist then.

    State and history are stored tables, so each run reads what the one before wrote:
    the state, the open versions and the changes since.
    """
    spark, root = feed.sparkSession, working_folder(feed.sparkSession)
    order, seen_until = ["updated_at", "change_id"], None
    for run in _run_times(feed):
        run_ts = timestamp(run.isoformat(sep=" "))
        new = feed.where(F.col("updated_at") < run_ts)
        if seen_until is not None:
            new = new.where(F.col("updated_at") >= seen_until)
            new = read_table(spark, f"{root}/state", feed.schema).unionByName(new)
        write_table(intervals.last_per_group(new, ["user_id"], order), f"{root}/state")
        source = read_table(spark, f"{root}/state", feed.schema).where(live).drop("present")
        keep_history(source, f"{root}/history", "user_id", run_ts=run_ts, **options)
        seen_until = run_ts
    schema = snapshots.history_schema(source, options.get("hard_deletes") == "new_record")
    return read_history(spark, f"{root}/history", schema)


@_query
def scd2_runs(spark, folder):
    """Snapshot after snapshot over the state at the end of each span of days."""
    versions = _snapshot_runs(adapter.user_changes(spark, folder), "true")
    return _versions_out(versions, "user_id", "region")


@_query
def scd2_runs_bulk(spark, folder):
    """The same history from the feed at once."""
    feed = adapter.user_changes(spark, folder)
    first = feed.agg(F.to_date(F.min("updated_at"))).scalar()
    run = F.floor(F.date_diff(F.to_date("updated_at"), first) / RUN_DAYS)
    versions = intervals.history_from_runs(feed, "user_id", "updated_at", run, "change_id")
    return _versions_out(versions, "user_id", "region")


@_query
def scd2_hard_deletes(spark, folder):
    versions = _snapshot_runs(
        adapter.user_presence(spark, folder), "present", hard_deletes="new_record"
    )
    return _versions_out(versions, "user_id", "score", F.col(IS_DELETED).alias("is_deleted"))


@_query
def scd2_deletes_ignored(spark, folder):
    versions = _snapshot_runs(adapter.user_presence(spark, folder), "present")
    return _versions_out(versions, "user_id", "score")


@_query
def scd2_initial_created_at(spark, folder):
    created = adapter.users(spark, folder).select("user_id", "created_at")
    feed = spread_left_join(
        adapter.user_changes(spark, folder), created, "user_id", ["change_id"]
    )
    corrected = intervals.history_from_feed(
        feed, "user_id", "updated_at", "change_id", initial_valid_from="created_at"
    )
    return _versions_out(corrected, "user_id", "region")


# --- analyses ----------------------------------------------------------------


@_query
def mau_by_region_month(spark, folder):
    return analyses.mau_by_region_and_month(
        fct_events(spark, folder), _history(spark, folder), YEAR
    )


@_query
def mau_window_asof(spark, folder):
    return analyses.mau_by_region_and_month(
        fct_events(spark, folder), _history(spark, folder), YEAR, method="asof"
    )


@_query
def mau_bucketed(spark, folder):
    """Facts and versions stored by user, joined where they are."""
    root, facts = working_folder(spark), fct_events(spark, folder)
    buckets = bucket_count(facts.count())
    stored = [
        write_bucketed(df, f"{root}/{name}", "user_id", buckets)
        for name, df in (("facts", facts), ("versions", _history(spark, folder)))
    ]
    return analyses.mau_by_region_and_month(*stored, YEAR, method="range")


@_query
def mau_from_daily(spark, folder):
    return analyses.mau_from_daily(agg_user_daily(spark, folder), _history(spark, folder), YEAR)


@_query
def active_users_by_period(spark, folder):
    """Distinct users per month, quarter and year from the stored sets of days, after some
    events came late and their days were computed again."""
    root, versions = working_folder(spark), _history(spark, folder)
    raw, middle = adapter.with_arrival(adapter.events(spark, folder)), _middle_day(spark, folder)
    daily = IncrementalTable(f"{root}/active", ("activity_date", "region", "bucket"), "activity_date")
    for delivered in (raw.where(F.col("arrival_date") <= F.lit(middle)), raw):
        days = incremental.load_new_rows(
            delivered, _staged(root), "created_at", staging.stg_events, lookback=LOOKBACK
        )
        incremental.recompute_days(
            _staged(root).read(spark),
            daily,
            "partition_date",
            lambda events: analyses.active_users_daily(events, versions),
            days,
        )
        incremental.days_followed(spark, _staged(root), days)
    parts = [
        analyses.active_users_by(daily.read(spark), period).select(F.lit(period).alias("period"), "*")
        for period in ("month", "quarter", "year")
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@_query
def creator_asof_post(spark, folder):
    posts = int_posts(spark, folder).select("post_id", "creator_id", "created_at")
    return analyses.creators_at_post_time(posts, _history(spark, folder), ["region"])


@_query
def date_spine(spark, folder):
    """The calendar of all days orders were placed between."""
    orders = adapter.table(spark, folder, "orders")
    return spine.spine_of(orders.select(F.to_date("o_orderdate").alias("day")), "day")


@_query
def daily_gap_filled(spark, folder):
    daily = agg_user_daily(spark, folder)
    return spine.fill_daily_gaps(daily, "user_id", "event_date", ["likes_given", "posts_viewed"])


@_query
def gap_filled_without_days(spark, folder):
    """Rows that lost their day stay as they are, next to the filled ones."""
    daily = agg_user_daily(spark, folder)
    lost = daily.withColumn("event_date", F.when(F.col("posts_viewed") != 1, F.col("event_date")))
    return spine.fill_daily_gaps(lost, "user_id", "event_date", ["likes_given", "posts_viewed"])


@_query
def like_ratio(spark, folder):
    return metrics.with_like_ratio(
        dim_posts(spark, folder).select("post_id", "likes", "views")
    )


@_query
def creator_like_ratio(spark, folder):
    totals = metrics.creator_totals(dim_posts(spark, folder))
    return metrics.with_like_ratio(totals, "total_likes", "total_views")


def _activity(spark, folder, daily, key):
    """Active on one of the last days of the data."""
    as_of = fct_events(spark, folder).agg(F.max("partition_date")).scalar()
    return metrics.activity(daily, key, ACTIVE_DAYS, as_of)


@_query
def active_creators(spark, folder):
    daily = metrics.creator_daily(agg_post_daily(spark, folder), int_posts(spark, folder))
    return _activity(spark, folder, daily, "creator_id")


@_query
def active_viewers(spark, folder):
    return _activity(spark, folder, agg_user_daily(spark, folder), "user_id")


@_query
def viewer_sessions_batch(spark, folder):
    return viewer_sessions(fct_events(spark, folder))


@_query
def dedup_likes(spark, folder):
    kept = metrics.without_repeated_likes(fct_events(spark, folder))
    return kept.select("event_id", "user_id", "post_id", "event_type", "created_at")


@_query
def dedup_likes_of_unknown_users(spark, folder):
    """Likes of unknown users repeat nothing."""
    kept = metrics.without_repeated_likes(_without_some_users(fct_events(spark, folder)))
    return kept.select("event_id", "user_id", "post_id", "event_type")


@_query
def post_length(spark, folder):
    posts = intermediate.with_post_length(int_posts(spark, folder))
    return posts.select("post_id", "post_text", "post_length")


# --- incremental -------------------------------------------------------------


def _middle_day(spark: SparkSession, folder: str) -> dt.date:
    """Half way between the first and the last day of the events."""
    first, last = (
        adapter.events(spark, folder)
        .agg(F.to_date(F.min("created_at")), F.to_date(F.max("created_at")))
        .first()
    )
    return first + (last - first) // 2


def _staged(root: str) -> IncrementalTable:
    return IncrementalTable(f"{root}/stg_events", ("event_id",), "partition_date")


def _daily(root: str, key: str) -> IncrementalTable:
    return IncrementalTable(f"{root}/agg_{key}", ("event_date", key), "event_date")


def _load_in_two_runs(spark: SparkSession, folder: str, root: str) -> Iterator[IncrementalTable]:
    """Stage events to the middle day, then, with all delivered, the newer ones."""
    raw, middle = adapter.events(spark, folder), _middle_day(spark, folder)
    for delivered in (raw.where(F.to_date("created_at") <= F.lit(middle)), raw):
        incremental.load_new_rows(delivered, _staged(root), "created_at", staging.stg_events)
        yield _staged(root)


@_query
def stg_events_incremental(spark, folder):
    *_, table = _load_in_two_runs(spark, folder, working_folder(spark))
    return table.read(spark)


def _daily_in_two_runs(spark, folder, key, aggregate):
    root = working_folder(spark)
    for staged in _load_in_two_runs(spark, folder, root):
        incremental.recompute_recent_days(
            staged.read(spark), _daily(root, key), staged.day, aggregate
        )
    return _daily(root, key).read(spark)


@_query
def agg_post_daily_incremental(spark, folder):
    return _daily_in_two_runs(spark, folder, "post_id", metrics.agg_post_metrics_daily)


@_query
def agg_user_daily_incremental(spark, folder):
    return _daily_in_two_runs(spark, folder, "user_id", metrics.agg_user_metrics_daily)


@_query
def late_and_tied_events(spark, folder):
    """Some events arrive a day late; at the second run those behind the watermark fall away."""
    raw, middle = adapter.with_arrival(adapter.events(spark, folder)), _middle_day(spark, folder)
    table = _staged(working_folder(spark))
    for delivered in (raw.where(F.col("arrival_date") <= F.lit(middle)), raw):
        incremental.load_new_rows(delivered, table, "created_at", staging.stg_events)
    return table.read(spark)


@_query
def replaced_events(spark, folder):
    """Events of one kind are sent again a week later and leave their old days."""
    staged = stg_events(spark, folder)
    table = _staged(working_folder(spark))
    incremental.full_refresh(staged, table)
    likes = staged.where("is_like = 1")
    moved = likes.withColumn("created_at", F.col("created_at") + F.expr("interval 7 days"))
    again = moved.withColumn("partition_date", F.to_date("created_at"))
    incremental.delete_insert(again, table)
    return table.read(spark)


def _follow(spark: SparkSession, staged: IncrementalTable, daily: IncrementalTable, days) -> None:
    """The daily user table after every changed day of the staged events."""
    incremental.recompute_days(
        staged.read(spark), daily, staged.day, metrics.agg_user_metrics_daily, days
    )
    incremental.days_followed(spark, staged, days)


@_query
def agg_user_daily_lookback(spark, folder):
    """Some events arrive a day late; a lookback picks them up, and their days follow."""
    raw, middle = adapter.with_arrival(adapter.events(spark, folder)), _middle_day(spark, folder)
    root = working_folder(spark)
    for delivered in (raw.where(F.col("arrival_date") <= F.lit(middle)), raw):
        days = incremental.load_new_rows(
            delivered, _staged(root), "created_at", staging.stg_events, lookback=LOOKBACK
        )
        _follow(spark, _staged(root), _daily(root, "user_id"), days)
    return _daily(root, "user_id").read(spark)


@_query
def refreshed_events(spark, folder):
    """Likes have vanished from the source, which no watermark sees: a refresh leaves them
    out of the staged events, and their days follow."""
    root, raw = working_folder(spark), adapter.events(spark, folder)
    for source, refresh in ((raw, False), (raw.where("event_type <> 'like'"), True)):
        days = incremental.load_new_rows(
            source, _staged(root), "created_at", staging.stg_events, refresh=refresh
        )
        _follow(spark, _staged(root), _daily(root, "user_id"), days)
    daily = _daily(root, "user_id").read(spark).groupBy("event_date").agg(
        F.count("*").alias("users"), F.sum("posts_viewed").alias("posts_viewed")
    )
    staged = _staged(root).read(spark).groupBy(F.col("partition_date").alias("event_date"))
    return staged.agg(F.count("*").alias("events")).join(daily, "event_date")


def _without_some_users(events: DataFrame) -> DataFrame:
    return events.withColumn("user_id", F.when(F.col("user_id") % 10 != 0, F.col("user_id")))


@_query
def agg_user_daily_resent(spark, folder):
    """Likes are sent again a week later, twice, and some users are unknown."""
    staged = _without_some_users(stg_events(spark, folder))
    root = working_folder(spark)
    table = _staged(root)
    _follow(spark, table, _daily(root, "user_id"), incremental.delete_insert(staged, table))
    likes = staged.where("is_like = 1")
    moved = likes.withColumn("created_at", F.col("created_at") + F.expr("interval 7 days"))
    again = moved.withColumn("partition_date", F.to_date("created_at"))
    for _ in range(2):
        _follow(spark, table, _daily(root, "user_id"), incremental.delete_insert(again, table))
    return _daily(root, "user_id").read(spark)


# --- changes -----------------------------------------------------------------


def _merged_users(spark: SparkSession, folder: str) -> DataFrame:
    return changes.merge_changes(
        adapter.users(spark, folder),
        adapter.user_change_batch(spark, folder),
        "user_id",
        adapter.USER_ATTRIBUTES,
    )


@_query
def apply_changes(spark, folder):
    return _merged_users(spark, folder).drop(changes.APPLIED)


@_query
def audit_counts(spark, folder):
    audit = changes.audit_row(
        _merged_users(spark, folder), "user", F.lit(INGEST_DATE), F.localtimestamp()
    )
    return audit.drop("real_timestamp")


@_query
def apply_tied_changes(spark, folder):
    """Changes of one day at the same time; the one with the highest id counts."""
    batch = adapter.user_change_batch(spark, folder)
    tied = batch.withColumn(changes.CHANGED_AT, F.date_trunc("day", changes.CHANGED_AT).cast("timestamp_ntz"))
    merged = changes.merge_changes(
        adapter.users(spark, folder), tied, "user_id", adapter.USER_ATTRIBUTES
    )
    return merged.select("user_id", "updated_at", "country_code", "favorite_color")


def _ingested(spark: SparkSession, folder: str) -> Warehouse:
    """All users and half of the events on one day, the changes and the rest on the next."""
    warehouse = Warehouse(working_folder(spark))
    events, middle = adapter.events(spark, folder), _middle_day(spark, folder)
    is_early = F.to_date("created_at") <= F.lit(middle)
    first = adapter.users(spark, folder).select(
        "user_id",
        F.lit("insert").alias(changes.CHANGE_TYPE),
        F.col("updated_at").alias(changes.CHANGED_AT),
        F.array().cast("array<string>").alias(changes.SET_COLUMNS),
        "created_at",
        *adapter.USER_ATTRIBUTES,
    )
    days = (first, events.where(is_early)), (adapter.user_change_batch(spark, folder), events.where(~is_early))
    for number, (batch, arrived) in enumerate(days):
        date = INGEST_DATE + dt.timedelta(days=number)
        ingest_day(spark, warehouse, {"user": batch}, arrived, date, FIRST_RUN)
    return warehouse


@_query
def raw_users_by_batches(spark, folder):
    """Raw users as a base and two days of the same changes, the first folded into a new base."""
    table = KeyedTable(f"{working_folder(spark)}/user", "user_id", fold_share=0.0)
    batch = adapter.user_change_batch(spark, folder)

    def changed(state: DataFrame | None) -> DataFrame:
        if state is None:
            return adapter.users(spark, folder).withColumn(changes.APPLIED, F.lit("inserted"))
        return changes.changed_rows(state.drop(changes.APPLIED), batch, "user_id", adapter.USER_ATTRIBUTES)

    for number in range(3):
        table.apply(spark, INGEST_DATE + dt.timedelta(days=number), changed)
    return table.read(spark).drop(changes.APPLIED, APPLIED_ON)


@_query
def ingestion_audit(spark, folder):
    """The audit log of two days."""
    log = spark.read.parquet(_ingested(spark, folder).path("raw", "ingestion_audit"))
    return log.drop("real_timestamp")


@_query
def ingestion_job_date(spark, folder):
    """The day after the last one in the audit log."""
    found = job_date(spark, _ingested(spark, folder), INGEST_DATE)
    return spark.range(1).select(F.lit(found).alias("job_date"))


@_query
def users_from_csv_lookup(spark, folder):
    """Users with their country from a CSV file."""
    path = f"{working_folder(spark)}/countries"
    countries = adapter.countries(spark, folder).select(
        "country_code", "name", F.lit("none").alias("currency"), "region", F.lit("").alias("subregion")
    )
    countries.write.option("header", True).csv(path)
    return intermediate.int_users(stg_users(spark, folder), read_countries(spark, path))


@_query
def views_by_sql(spark, folder):
    """The published views, asked in SQL."""
    warehouse = _two_builds(spark, folder)
    raw = adapter.users(spark, folder), adapter.posts(spark, folder)
    publish_views(spark, warehouse, *raw, adapter.countries(spark, folder))
    return spark.sql(
        """
        SELECT f.partition_date, f.event_type, p.creator_region, count(*) AS n_events
        FROM fct_events f LEFT JOIN int_posts p ON f.post_id = p.post_id
        GROUP BY f.partition_date, f.event_type, p.creator_region"""
    )


@_query
def live_row_summary(spark, folder):
    return changes.live_row_summary(
        {
            "user": adapter.users(spark, folder),
            "post": adapter.posts(spark, folder),
            "event": adapter.events(spark, folder),
        }
    )


@_query
def next_job_date(spark, folder):
    """One audit row per day of events; the next job is for the day after the last."""
    audit = (
        adapter.events(spark, folder)
        .groupBy(F.to_date("created_at").alias("ingest_date"))
        .agg(F.count("*").alias("rows_inserted"))
    )
    return changes.next_job_date(audit, F.lit(dt.date(2100, 1, 1)))


@_query
def random_live_sample(spark, folder):
    users = adapter.users(spark, folder)
    return random_live_rows(users, "user_id", SAMPLE_ROWS, SAMPLE_SEED).select(
        "user_id", "country_code"
    )


@_query
def random_posts_before(spark, folder):
    posts = adapter.posts(spark, folder)
    before = timestamp("2024-01-16 00:00:00")
    return random_live_rows(posts, "post_id", SAMPLE_ROWS, SAMPLE_SEED, before).select(
        "post_id", "created_at"
    )


# --- data tests --------------------------------------------------------------


@_query
def dq_not_null(spark, folder):
    users = adapter.users(spark, folder)
    return quality.not_null(users, "user_id", "last_name", "deleted_at", "favorite_color")


@_query
def dq_unique(spark, folder):
    return quality.duplicate_keys(adapter.posts(spark, folder), "post_text")


@_query
def dq_accepted_values(spark, folder):
    events = adapter.table(spark, folder, "events")
    return quality.accepted_values(events, "event_type", ("view", "purchase"))


@_query
def dq_relationships(spark, folder):
    """Users with events who are not in the dimension, being deleted."""
    live = adapter.users(spark, folder).where("deleted_at is null")
    return quality.orphan_keys(adapter.events(spark, folder), "user_id", live, "user_id")


@_query
def dq_suite(spark, folder):
    """All declared tests of all tables; built ones are read from where they are stored."""
    root, tables = working_folder(spark), {}

    def keep(name: str, built: DataFrame) -> DataFrame:
        write_table(built, f"{root}/{name}")
        tables[name] = read_table(spark, f"{root}/{name}", built.schema)
        return tables[name]

    users = int_users(spark, folder)
    posts = intermediate.int_posts(stg_posts(spark, folder), users)
    live_posts = keep("dim_posts", dimensions.dim_posts(posts, agg_post_daily(spark, folder)))
    keep("dim_users", dimensions.dim_users(users, agg_user_daily(spark, folder), live_posts))
    tables |= {
        "user": adapter.users(spark, folder),
        "post": adapter.posts(spark, folder),
        "event": adapter.events(spark, folder),
        "stg_events": stg_events(spark, folder),
        "fct_events": fct_events(spark, folder),
    }
    return quality.run_tests(tables, quality.SUITE)


@_query
def dq_suite_with_faults(spark, folder):
    """All declared tests of tables with missing, repeated, foreign and orphaned values."""
    users, posts = adapter.users(spark, folder), adapter.posts(spark, folder)
    events = adapter.events(spark, folder)
    user = users.where("user_id % 7 <> 3").withColumns(
        {
            "first_name": F.when(F.col("user_id") % 11 != 0, F.col("first_name")),
            "country_code": F.when(F.col("user_id") % 13 != 0, F.col("country_code")),
        }
    )
    user = user.unionByName(user.where("user_id % 5 = 0"))
    # Some posts twice, some missing.
    post = posts.withColumn("post_text", F.when(F.col("post_id") % 9 != 0, F.col("post_text")))
    post = post.where("post_id % 4 <> 1").unionByName(post.where("post_id % 6 = 0"))
    event = events.withColumn("user_id", F.when(F.col("event_id") % 17 != 0, F.col("user_id")))
    event = event.unionByName(events.where("event_id % 8 = 0"))
    staged = staging.stg_events(event)
    live_users = intermediate.int_users(staging.stg_users(user), adapter.countries(spark, folder))
    live_posts = intermediate.int_posts(staging.stg_posts(post), intermediate.int_users(
        staging.stg_users(users.where("user_id % 7 <> 3")), adapter.countries(spark, folder)
    ))
    tables = {
        "user": user,
        "post": post,
        "event": event,
        "stg_events": staged,
        "dim_users": live_users.where("deleted_at is null"),
        "dim_posts": live_posts.where("deleted_at is null"),
        "fct_events": staged,
    }
    return quality.run_tests(tables, quality.SUITE)


# --- streaming ---------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream, as it is given."""
    return streams.read_stream(spark, f"{folder}/events.parquet", adapter.schema("events"))


def _deliveries(spark: SparkSession, *batches: DataFrame) -> Iterator[DataFrame]:
    """The stream of a folder, each time another batch of raw events has been put there."""
    path = f"{working_folder(spark)}/delivered"
    for batch in batches:
        batch.write.mode("append").parquet(path)
        yield streams.read_stream(spark, path, batch.schema)


@_query
def stream_daily_metrics(spark, folder):
    """Three deliveries: half of the events, with some users wrong, the rest, and the
    wrong ones again as they should be."""
    root = working_folder(spark)
    tables = (_staged(root), _daily(root, "post_id"), _daily(root, "user_id"))
    events, middle = adapter.events(spark, folder), _middle_day(spark, folder)
    early, wrong = F.to_date("created_at") <= F.lit(middle), F.col("event_id") % 3 == 0
    first = events.where(early).withColumn("user_id", F.when(wrong, -1).otherwise(F.col("user_id")))
    for raw in _deliveries(spark, first, events.where(~early), events.where(early & wrong)):
        streams.run_available(streams.build_daily_tables(raw, *tables), f"{root}/progress")
    return tables[2].read(spark)


@_query
def stream_history(spark, folder):
    """Three deliveries of changes, a snapshot run each."""
    feed, root = adapter.user_changes(spark, folder), working_folder(spark)
    first, last = feed.agg(F.to_date(F.min("updated_at")), F.to_date(F.max("updated_at"))).first()
    third = F.floor(F.date_diff(F.to_date("updated_at"), F.lit(first)) * 3 / F.lit((last - first).days + 1))
    history = StreamedHistory(f"{root}/history", "user_id", "updated_at", "change_id")
    for changes_ in _deliveries(spark, *[feed.where(third == number) for number in range(3)]):
        streams.run_available(keep_streamed_history(changes_, history), f"{root}/progress")
    return _versions_out(history.read(spark), "user_id", "region")


def _run_to_table(stream: DataFrame, root: str) -> DataFrame:
    writer = stream.writeStream.format("parquet").option("path", f"{root}/out")
    streams.run_available(writer.outputMode("append"), f"{root}/progress")
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


@_query
def stream_dedup(spark, folder):
    """Every event delivered twice, kept once."""
    once, again = (adapter.as_events(_event_stream(spark, folder)) for _ in range(2))
    kept = streams.deduplicated(once.unionAll(again), "created_at", STREAM_DELAY)
    return _run_to_table(kept, working_folder(spark))


@_query
def stream_sessions(spark, folder):
    """Sessions of two deliveries, and those that are still open at the end."""
    events, middle = adapter.events(spark, folder), _middle_day(spark, folder)
    early = F.to_date("created_at") <= F.lit(middle)
    root = working_folder(spark)
    for raw in _deliveries(spark, events.where(early), events.where(~early)):
        sessions = streams.stream_sessions(raw, "user_id", "created_at", STREAM_DELAY)
        emitted = _run_to_table(sessions, root)
    still_open = streams.open_sessions(spark, f"{root}/progress", "user_id")
    return emitted.unionByName(still_open)
