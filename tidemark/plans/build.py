"""The daily run: apply changes to the raw tables, audit them, build all layers."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import APPLIED, audit_row, changed_rows, next_job_date
from tidemark.operators.incremental import (
    IncrementalTable,
    days_followed,
    load_new_rows,
    recompute_days,
)
from tidemark.operators.quality import SUITE, run_tests
from tidemark.operators.snapshots import history_schema, snapshot_run
from tidemark.plans.dimensions import dim_posts, dim_users, fct_events
from tidemark.plans.intermediate import int_events, int_posts, int_users
from tidemark.plans.metrics import agg_post_metrics_daily, agg_user_metrics_daily
from tidemark.plans.staging import stg_events, stg_posts, stg_users
from tidemark.schemas import AUDIT, RAW, timestamp
from tidemark.session import together
from tidemark.sources.keyed import APPLIED_ON, KeyedTable
from tidemark.sources.paths import partition_days
from tidemark.sources.tables import (
    drop_old_open_versions,
    drop_old_versions,
    publish_view,
    read_history,
    read_table,
    replace_partitions,
    write_history,
    write_table,
)

ATTRIBUTES = {
    "user": ["first_name", "last_name", "country_code", "favorite_color"],
    "post": ["user_id", "post_text"],
}


@dataclass(frozen=True)
class Warehouse:
    """Folder of the warehouse; each layer has a folder of its own."""

    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def raw(self, name: str) -> KeyedTable:
        """Raw users or posts."""
        return KeyedTable(self.path("raw", name), f"{name}_id")

    @property
    def stg_events(self) -> IncrementalTable:
        return IncrementalTable(self.path("staging", "stg_events"), ("event_id",), "partition_date")

    @property
    def agg_post_daily(self) -> IncrementalTable:
        return self._daily("agg_post_metrics_daily", "post_id")

    @property
    def agg_user_daily(self) -> IncrementalTable:
        return self._daily("agg_user_metrics_daily", "user_id")

    def _daily(self, name: str, key: str) -> IncrementalTable:
        return IncrementalTable(self.path("analytics", name), ("event_date", key), "event_date")


def job_date(spark: SparkSession, warehouse: Warehouse, first: dt.date) -> dt.date:
    """The day to ingest next: after the last one audited, or ``first``."""
    path = warehouse.path("raw", "ingestion_audit")
    if not partition_days(spark, path, "ingest_date"):
        return first
    audit = spark.read.schema(AUDIT).parquet(path)
    return next_job_date(audit, F.lit(first)).first()[0]


def ingest_day(
    spark: SparkSession,
    warehouse: Warehouse,
    changes: dict[str, DataFrame],
    events: DataFrame,
    ingest_date: dt.date,
    now: dt.datetime,
) -> None:
    """Apply a day's changes to raw users and posts, add its events, audit both.

    Only rows that change are written. Everything is keyed by the day, so a run that broke
    off is simply repeated; days come in order.
    """
    audits = []
    day, at = F.lit(ingest_date), timestamp(now.isoformat(sep=" "))
    for table, batch in changes.items():

        def changed(state: DataFrame | None, table: str = table, batch: DataFrame = batch) -> DataFrame:
            state = _without_marks(state, spark, table, batch)
            return changed_rows(state, batch, f"{table}_id", ATTRIBUTES[table])

        applied = warehouse.raw(table).apply(spark, ingest_date, changed)
        audits.append(audit_row(applied, table, day, at))

    of_day = f"{warehouse.path('raw', 'event')}/ingest_date={ingest_date.isoformat()}"
    events.write.mode("overwrite").parquet(of_day)
    added = spark.read.parquet(of_day).withColumn(APPLIED, F.lit("inserted"))
    audits.append(audit_row(added, "event", day, at))

    rows = reduce(DataFrame.unionByName, audits)
    replace_partitions(
        rows, warehouse.path("raw", "ingestion_audit"), ["ingest_date", "table_name"]
    )


def raw_events(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return spark.read.parquet(warehouse.path("raw", "event")).drop("ingest_date")


def raw_state(
    spark: SparkSession, warehouse: Warehouse, table: str, like: DataFrame | None = None
) -> DataFrame:
    """Raw users or posts as they are; before the first load an empty table, its
    columns typed as in the batch ``like``."""
    return _without_marks(warehouse.raw(table).read(spark), spark, table, like)


def _without_marks(
    state: DataFrame | None, spark: SparkSession, table: str, like: DataFrame | None
) -> DataFrame:
    if state is not None:
        return state.drop(APPLIED, APPLIED_ON)
    empty = spark.createDataFrame([], RAW[table])
    kinds = dict(like.dtypes) if like is not None else {}
    return empty.select(
        *[F.col(name).cast(kinds.get(name, kind)) for name, kind in empty.dtypes]
    )


def take_raw_snapshots(spark: SparkSession, warehouse: Warehouse) -> None:
    """History of the raw tables. A job of its own, so that no failure of the
    build loses a change of the source."""

    def snapshot(table: str, key: str) -> None:
        path = warehouse.path("raw_history", table)
        keep_history(raw_state(spark, warehouse, table), path, key)

    together(spark, partial(snapshot, "user", "user_id"), partial(snapshot, "post", "post_id"))


def keep_history(source: DataFrame, path: str, key: str, **options) -> None:
    """One snapshot run over a stored history: reads and writes open versions only."""
    spark, record = source.sparkSession, options.get("hard_deletes") == "new_record"
    open_versions = read_history(spark, path, history_schema(source, record), only_open=True)
    write_history(snapshot_run(open_versions, source, key, "updated_at", **options), path)
    drop_old_open_versions(spark, path)


def history(warehouse: Warehouse, layer: str, name: str, source: DataFrame, record: bool = False) -> DataFrame | None:
    """All versions of a stored history of rows like ``source``."""
    path = warehouse.path(layer, name)
    return read_history(source.sparkSession, path, history_schema(source, record))


def build(
    spark: SparkSession,
    warehouse: Warehouse,
    user: DataFrame,
    post: DataFrame,
    event: DataFrame,
    countries: DataFrame,
    run_ts: dt.datetime,
    refresh: bool = False,
    lookback: dt.timedelta | None = None,
) -> None:
    """Build every layer. ``run_ts`` is the time a vanished row counts as deleted.

    ``refresh`` builds the incremental tables from nothing. Histories go on even
    then: what the tables once were cannot be found out again. ``lookback`` picks up
    late events; the daily tables follow every day that changed.
    """
    days = load_new_rows(event, warehouse.stg_events, "created_at", stg_events, refresh, lookback)
    events = int_events(warehouse.stg_events.read(spark))
    together(
        spark,
        *(
            partial(recompute_days, events, table, "partition_date", aggregate, days)
            for table, aggregate in (
                (warehouse.agg_post_daily, agg_post_metrics_daily),
                (warehouse.agg_user_daily, agg_user_metrics_daily),
            )
        ),
    )
    days_followed(spark, warehouse.stg_events, days)

    analytics = {name: warehouse.path("analytics", name) for name in ("dim_posts", "dim_users")}
    users = int_users(stg_users(user), countries)
    posts = int_posts(stg_posts(post), users)
    write_table(dim_posts(posts, warehouse.agg_post_daily.read(spark)), analytics["dim_posts"])
    live_posts = read_table(spark, analytics["dim_posts"])
    write_table(
        dim_users(users, warehouse.agg_user_daily.read(spark), live_posts),
        analytics["dim_users"],
    )

    at = timestamp(run_ts.isoformat(sep=" "))

    def snapshot(name: str, key: str) -> None:
        source, path = read_table(spark, analytics[name]), warehouse.path("analytics", f"{name}_snapshots")
        keep_history(source, path, key, run_ts=at, hard_deletes="new_record")

    together(
        spark, partial(snapshot, "dim_users", "user_id"), partial(snapshot, "dim_posts", "post_id")
    )
    for path in analytics.values():
        drop_old_versions(spark, path)


def publish_views(
    spark: SparkSession, warehouse: Warehouse, user: DataFrame, post: DataFrame, countries: DataFrame
) -> None:
    """Every model under its name, for queries in SQL. Nothing is computed here."""
    staged = warehouse.stg_events.read(spark)
    users, posts = stg_users(user), stg_posts(post)
    models = {
        "stg_users": users,
        "stg_posts": posts,
        "stg_events": staged,
        "int_users": int_users(users, countries),
        "fct_events": fct_events(int_events(staged)),
        "agg_post_metrics_daily": warehouse.agg_post_daily.read(spark),
        "agg_user_metrics_daily": warehouse.agg_user_daily.read(spark),
    }
    models["int_posts"] = int_posts(posts, models["int_users"])
    for name in ("dim_users", "dim_posts"):
        models[name] = read_table(spark, warehouse.path("analytics", name))
        snapshots = f"{name}_snapshots"
        models[snapshots] = history(warehouse, "analytics", snapshots, models[name], record=True)
    for name, model in models.items():
        publish_view(model, name)


def test_results(
    spark: SparkSession, warehouse: Warehouse, user: DataFrame, post: DataFrame, event: DataFrame
) -> DataFrame:
    """Failures of all declared data tests on the raw and the built tables."""
    staged = warehouse.stg_events.read(spark)
    tables = {"user": user, "post": post, "event": event, "stg_events": staged}
    tables["fct_events"] = int_events(staged)
    for name in ("dim_users", "dim_posts"):
        tables[name] = read_table(spark, warehouse.path("analytics", name))
    return run_tests(tables, SUITE)

