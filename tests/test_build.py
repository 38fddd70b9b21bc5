import datetime as dt

import pytest
from helpers import at, day, rows, table
from pyspark.sql import functions as F

from tidemark.plans.build import (
    Warehouse,
    build,
    ingest_day,
    job_date,
    publish_views,
    raw_events,
    raw_state,
    take_raw_snapshots,
)
from tidemark.plans.build import history as stored_history
from tidemark.plans.build import test_results as check
from tidemark.plans.analyses import mau_by_region_and_month
from tidemark.sources.tables import read_table

EVENT = "event_id string, user_id string, post_id string, created_at timestamp_ntz, event_type string"
FIRST = dt.date(2100, 1, 1)


def time(n, hour=10):
    return f"2100-01-0{n} {hour:02d}:00:00"


def user_changes(spark, *rows_):
    """Rows of (id, type, time, country)."""
    columns = (
        "user_id string, change_type string, changed_at timestamp_ntz, created_at timestamp_ntz, "
        "first_name string, last_name string, country_code string, favorite_color string"
    )
    full = [(u, kind, t, t, "A", "B", country, "red") for u, kind, t, country in rows_]
    return table(spark, columns, *full).withColumn("set_columns", F.array(F.lit("country_code")))


def post_changes(spark, *rows_):
    """Rows of (id, type, time, creator)."""
    columns = (
        "post_id string, change_type string, changed_at timestamp_ntz, created_at timestamp_ntz, "
        "user_id string, post_text string"
    )
    full = [(p, kind, t, t, creator, "text") for p, kind, t, creator in rows_]
    return table(spark, columns, *full).withColumn("set_columns", F.array(F.lit("post_text")))


@pytest.fixture
def countries(spark):
    return spark.createDataFrame(
        [("NA", "Namibia", "Africa"), ("FR", "France", "Europe")],
        "country_code string, name string, region string",
    )


def snapshots_of(spark, warehouse):
    users = read_table(spark, warehouse.path("analytics", "dim_users"))
    return stored_history(warehouse, "analytics", "dim_users_snapshots", users, record=True)


def test_two_days(spark, tmp_path, countries):
    warehouse = Warehouse(str(tmp_path))

    def run(date, users, posts, events):
        changes = {"user": user_changes(spark, *users), "post": post_changes(spark, *posts)}
        batch = table(spark, EVENT, *events)
        # Twice, as after a run that broke off at its end.
        for _ in range(2):
            ingest_day(spark, warehouse, changes, batch, date, at("2026-01-01 00:00:00"))
        for _ in range(2):
            take_raw_snapshots(spark, warehouse)
            build(
                spark,
                warehouse,
                raw_state(spark, warehouse, "user"),
                raw_state(spark, warehouse, "post"),
                raw_events(spark, warehouse),
                countries,
                dt.datetime.combine(date, dt.time()) + dt.timedelta(days=1),
            )

    assert job_date(spark, warehouse, FIRST) == FIRST
    run(
        FIRST,
        [("u", "insert", time(1), "NA"), ("v", "insert", time(1), "NA"), ("w", "insert", time(1), None)],
        [("p", "insert", time(1), "u"), ("q", "insert", time(1), "v")],
        [
            ("1", "u", "q", time(1, 11), "view"),
            ("2", "v", "p", time(1, 12), "view"),
            ("3", "v", "p", time(1, 13), "like"),
            ("0", "w", "p", time(1, 9), "view"),
        ],
    )
    second = job_date(spark, warehouse, FIRST)
    assert second == dt.date(2100, 1, 2)
    run(
        second,
        [("v", "delete", time(2), None), ("u", "update", time(2), "FR")],
        [("q", "delete", time(2), None)],
        [("4", "u", "p", time(2, 11), "view"), ("5", "v", "q", time(2, 12), "like")],
    )

    audit = spark.read.parquet(warehouse.path("raw", "ingestion_audit"))
    counts = ("ingest_date", "table_name", "rows_inserted", "rows_updated", "rows_deleted")
    assert rows(audit, *counts) == [
        (FIRST, "event", 4, 0, 0),
        (FIRST, "post", 2, 0, 0),
        (FIRST, "user", 3, 0, 0),
        (second, "event", 2, 0, 0),
        (second, "post", 0, 0, 1),
        (second, "user", 0, 1, 1),
    ]
    raw_history = stored_history(warehouse, "raw_history", "user", raw_state(spark, warehouse, "user"))
    span = [F.col(f"dbt_valid_{c}").cast("string") for c in ("from", "to")]
    open_end = "9999-12-31 00:00:00"
    assert rows(raw_history, "user_id", "country_code", *span) == [
        ("u", "FR", time(2), open_end),
        ("u", "NA", time(1), time(2)),
        ("v", "NA", time(1), time(2)),
        ("v", "NA", time(2), open_end),
        ("w", None, time(1), open_end),
    ]

    posts = read_table(spark, warehouse.path("analytics", "dim_posts"))
    assert rows(posts, "post_id", "creator_region", "likes", "views") == [("p", "Europe", 1, 3)]
    users = read_table(spark, warehouse.path("analytics", "dim_users"))
    metric = ("likes_given", "posts_viewed", "total_likes", "total_views")
    assert rows(users, "user_id", "region", *metric) == [
        ("u", "Europe", 0, 2, 1, 3),
        ("w", "Unknown", 0, 1, 0, 0),
    ]
    history = snapshots_of(spark, warehouse)
    midnight = "2100-01-03 00:00:00"
    assert rows(history, "user_id", "region", *span, "dbt_is_deleted") == [
        ("u", "Africa", time(1), time(2), "False"),
        ("u", "Europe", time(2), open_end, "False"),
        ("v", "Africa", time(1), midnight, "False"),
        ("v", "Africa", midnight, open_end, "True"),
        ("w", "Unknown", time(1), open_end, "False"),
    ]
    # Metrics do not open versions, so they are as of the opening.
    opened = history.where("user_id = 'w'").first()
    assert opened["posts_viewed"] == 1

    raw = [raw_state(spark, warehouse, name) for name in ("user", "post")]
    publish_views(spark, warehouse, *raw, countries)
    mau = mau_by_region_and_month(spark.table("fct_events"), history, 2100)
    expected = [
        (day("2100-01-01"), "Africa", 2),
        (day("2100-01-01"), "Europe", 1),
        (day("2100-01-01"), None, 1),
    ]
    assert rows(mau) == sorted(expected, key=repr)
    by_hand = spark.sql(
        """
        SELECT trunc(f.created_at, 'month') AS activity_month, s.region,
               count(DISTINCT f.user_id) AS mau
        FROM fct_events f LEFT JOIN dim_users_snapshots s ON f.user_id = s.user_id
            AND f.created_at >= s.dbt_valid_from AND f.created_at < s.dbt_valid_to
        WHERE year(partition_date) = 2100 GROUP BY ALL"""
    )
    assert rows(by_hand) == rows(mau)
    names = {v.name for v in spark.catalog.listTables() if v.isTemporary}
    assert {"stg_users", "stg_posts", "int_users", "int_posts", "dim_posts_snapshots"} <= names


def test_refresh_starts_over(spark, tmp_path, countries):
    warehouse = Warehouse(str(tmp_path))
    users = user_changes(spark, ("u", "insert", time(1), "NA"))
    posts = post_changes(spark, ("p", "insert", time(1), "u"))
    events = table(spark, EVENT, ("1", "u", "p", time(1), "view"))
    ingest_day(spark, warehouse, {"user": users, "post": posts}, events, FIRST, at(time(1)))
    raw = [raw_state(spark, warehouse, name) for name in ("user", "post")]
    late = table(spark, EVENT, ("0", "u", "p", time(1, 9), "view"))
    build(spark, warehouse, *raw, events, countries, at(time(2)))
    build(spark, warehouse, *raw, events.unionAll(late), countries, at(time(3)))
    assert warehouse.stg_events.read(spark).count() == 1
    build(spark, warehouse, *raw, events.unionAll(late), countries, at(time(4)), refresh=True)
    assert warehouse.stg_events.read(spark).count() == 2
    history = snapshots_of(spark, warehouse)
    assert history.count() == 1
    failed = check(spark, warehouse, *raw, events.unionAll(late)).where("failures > 0")
    assert failed.isEmpty()
    orphans = check(spark, warehouse, raw[0].where("false"), raw[1], events).where("failures > 0")
    assert rows(orphans, "table_name", "test", "column_name", "failures") == [
        ("event", "relationships", "user_id", 1),
        ("post", "relationships", "user_id", 1),
    ]
