"""Histories stored run by run, days that follow, and changes that tie."""

import datetime as dt

from helpers import day, rows, table
from pyspark.sql import functions as F

from tidemark.operators import changes
from tidemark.operators import incremental as inc
from tidemark.operators.incremental import IncrementalTable
from tidemark.operators.snapshots import history_schema
from tidemark.plans.build import keep_history
from tidemark.plans.metrics import agg_user_metrics_daily, without_repeated_likes
from tidemark.plans.staging import stg_events
from tidemark.sources import paths
from tidemark.sources.tables import read_history

SOURCE = "id string, value string, created_at timestamp_ntz, updated_at timestamp_ntz"
EVENT = "event_id string, user_id string, post_id string, created_at timestamp_ntz, event_type string"


def source(spark, *values):
    return table(spark, SOURCE, *[(i, v, "2100-01-01 00:00:00", f"2100-01-0{d} 00:00:00") for i, v, d in values])


def test_closed_versions_are_written_once(spark, tmp_path):
    path = f"{tmp_path}/history"
    for state in (
        [("a", "x", 1), ("b", "x", 1)],
        [("a", "y", 2), ("b", "x", 1)],
        [("a", "y", 2), ("b", "x", 1)],
        [("a", "z", 3), ("b", "x", 1)],
    ):
        keep_history(source(spark, *state), path, "id")
    schema = history_schema(source(spark, ("a", "x", 1)))
    closed = F.col("dbt_valid_to") < "9999-01-01"
    versions = read_history(spark, path, schema).select("id", "value", closed.alias("closed"))
    assert rows(versions) == [("a", "x", True), ("a", "y", True), ("a", "z", False), ("b", "x", False)]
    assert rows(read_history(spark, path, schema, only_open=True), "id", "value") == [("a", "z"), ("b", "x")]
    for run, ids in ((0, None), (1, [("x",)]), (2, None), (3, [("y",)])):
        folder = f"{path}/v={run}/_open=false"
        assert paths.exists(spark, folder) == (ids is not None)
        if ids:
            assert rows(spark.read.parquet(folder), "value") == ids
    assert not paths.exists(spark, f"{path}/v=0/_open=true")


def test_a_run_that_broke_off_does_not_count(spark, tmp_path):
    path = f"{tmp_path}/history"
    keep_history(source(spark, ("a", "x", 1)), path, "id")
    spark.range(1).write.parquet(f"{path}/v=1/_open=true")
    schema = history_schema(source(spark, ("a", "x", 1)))
    assert read_history(spark, path, schema).count() == 1
    keep_history(source(spark, ("a", "y", 2)), path, "id")
    assert read_history(spark, path, schema).count() == 2


def test_an_initial_start_opens_one_version_only(spark, tmp_path):
    path = f"{tmp_path}/history"
    for state in ([("a", "x", 3)], [("a", "x", 3)], [("a", "y", 5)], [("a", "y", 5)]):
        keep_history(source(spark, *state), path, "id", initial_valid_from="created_at")
    found = read_history(spark, path, history_schema(source(spark, ("a", "x", 1))))
    spans = [F.col(f"dbt_valid_{c}").cast("string") for c in ("from", "to")]
    assert rows(found, "value", *spans) == [
        ("x", "2100-01-01 00:00:00", "2100-01-05 00:00:00"),
        ("y", "2100-01-05 00:00:00", "9999-12-31 00:00:00"),
    ]


def daily(spark, staged, table_, days):
    inc.recompute_days(staged.read(spark), table_, "partition_date", agg_user_metrics_daily, days)
    return rows(table_.read(spark), "event_date", "user_id", "posts_viewed")


def test_daily_rows_follow_late_resent_and_unknown(spark, tmp_path):
    staged = IncrementalTable(f"{tmp_path}/stg", ("event_id",), "partition_date")
    users = IncrementalTable(f"{tmp_path}/agg", ("event_date", "user_id"), "event_date")

    def load(*events, **options):
        raw = table(spark, EVENT, *[(e, u, "p", f"2100-01-{t}", "view") for e, u, t in events])
        return inc.load_new_rows(raw, staged, "created_at", stg_events, **options)

    first = [("a", "u", "01 10:00:00"), ("b", None, "02 10:00:00"), (None, "v", "02 11:00:00")]
    days = load(*first)
    assert days is None
    one, two, three = (day(f"2100-01-0{n}") for n in (1, 2, 3))
    whole = [(one, "u", 1), (two, None, 1), (two, "v", 1)]
    assert daily(spark, staged, users, days) == sorted(whole, key=repr)
    inc.days_followed(spark, staged)
    # A late row within the lookback, the only row of the first day moves to the third,
    # and all the rest once more.
    again = [*first[1:], ("late", "u", "01 23:00:00"), ("a", "u", "03 01:00:00")]
    days = load(*again, lookback=dt.timedelta(days=1))
    assert days == {one, two, three}
    assert inc.changed_days(spark, staged) == days
    # Followed only in the run after: the days are still known.
    days = load(*again)
    assert days == {one, two, three}
    expected = [(one, "u", 1), (two, None, 1), (two, "v", 1), (three, "u", 1)]
    assert daily(spark, staged, users, days) == sorted(expected, key=repr)
    inc.days_followed(spark, staged)
    assert inc.changed_days(spark, staged) == frozenset()
    assert staged.read(spark).count() == 4


def test_a_day_that_lost_all_rows_is_empty(spark, tmp_path):
    staged = IncrementalTable(f"{tmp_path}/stg", ("event_id",), "partition_date")
    users = IncrementalTable(f"{tmp_path}/agg", ("event_date", "user_id"), "event_date")

    def events(time):
        return stg_events(table(spark, EVENT, ("a", "u", "p", time, "view")))

    daily(spark, staged, users, inc.delete_insert(events("2100-01-01 10:00:00"), staged))
    days = inc.delete_insert(events("2100-01-02 10:00:00"), staged)
    assert daily(spark, staged, users, days) == [(day("2100-01-02"), "u", 1)]


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    columns = (
        "id string, change_type string, changed_at timestamp_ntz, created_at timestamp_ntz, value string, change_id int"
    )
    at = "2100-01-02 00:00:00"
    batch = [("a", "update", at, None, v, n) for v, n in (("x", 2), ("z", 1), ("y", 3))]
    state = table(
        spark,
        "id string, value string, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz",
        ("a", "old", "2100-01-01 00:00:00", "2100-01-01 00:00:00", None),
    )
    for order in (batch, batch[::-1], [batch[1], batch[0], batch[2]]):
        for with_id, expected in ((True, "y"), (False, "z")):
            df = table(spark, columns, *order).withColumn("set_columns", F.array(F.lit("value")))
            df = df if with_id else df.drop("change_id")
            merged = changes.apply_changes(state, df.coalesce(1), "id", ["value"])
            assert rows(merged, "value") == [(expected,)]


def test_likes_of_unknown_users_stay(spark):
    at = "2100-01-01 10:00:00"
    events = table(
        spark, EVENT,
        ("1", None, "p", at, "like"), ("2", None, "p", at, "like"), ("3", "u", None, at, "like"),
        ("4", "u", None, at, "like"), ("5", "u", "p", at, "like"), ("6", "u", "p", at, "like"),
    )
    assert rows(without_repeated_likes(stg_events(events)), "event_id") == [("1",), ("2",), ("3",), ("4",), ("5",)]
