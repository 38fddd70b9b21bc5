import datetime as dt

import pytest
from helpers import rows, table

from tidemark.operators.incremental import IncrementalTable
from tidemark.operators.sessions import viewer_sessions
from tidemark.plans.metrics import agg_post_metrics_daily, agg_user_metrics_daily
from tidemark.plans.staging import stg_events
from tidemark.schemas import EVENT as SCHEMA
from tidemark.streaming import events as streams

EVENT = "event_id string, user_id string, post_id string, created_at timestamp_ntz, event_type string"


def event(name, time, kind="view", user="u"):
    return (name, user, "p", f"2100-01-{time}", kind)


@pytest.fixture
def deliver(spark, tmp_path):
    """Adds one file of events to the source folder."""

    def add(*events):
        table(spark, EVENT, *events).coalesce(1).write.mode("append").parquet(f"{tmp_path}/source")

    return add


def tables(tmp_path):
    return (
        IncrementalTable(f"{tmp_path}/stg", ("event_id",), "partition_date"),
        IncrementalTable(f"{tmp_path}/posts", ("event_date", "post_id"), "event_date"),
        IncrementalTable(f"{tmp_path}/users", ("event_date", "user_id"), "event_date"),
    )


def test_microbatches_keep_the_daily_tables_up_to_date(spark, tmp_path, deliver):
    staged, posts, users = tables(tmp_path)

    def run(progress="progress"):
        source = streams.read_stream(spark, f"{tmp_path}/source", SCHEMA)
        writer = streams.build_daily_tables(source, staged, posts, users)
        streams.run_available(writer, f"{tmp_path}/{progress}")
        events = staged.read(spark)
        for table_, aggregate in ((posts, agg_post_metrics_daily), (users, agg_user_metrics_daily)):
            expected = aggregate(events)
            found = table_.read(spark).select(expected.columns)
            assert rows(found) == rows(expected)
        return [(name, str(date)) for name, date in rows(events, "event_id", "partition_date")]

    deliver(event("a", "01 10:00:00"), event("b", "01 11:00:00", "like"), event("c", "02 10:00:00"))
    assert run() == [("a", "2100-01-01"), ("b", "2100-01-01"), ("c", "2100-01-02")]
    # Late events count here, and an event sent again moves, its old day included.
    deliver(event("late", "01 09:00:00", user="v"), event("c", "03 10:00:00"))
    expected = [
        ("a", "2100-01-01"),
        ("b", "2100-01-01"),
        ("c", "2100-01-03"),
        ("late", "2100-01-01"),
    ]
    assert run() == expected
    assert run() == expected
    # All of it delivered once more, in one batch in which c comes twice.
    source = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/source")
    assert source.count() == 5
    assert len(run("other progress")) == 5


def test_backlog_is_worked_off_in_steps(spark, tmp_path, deliver):
    for i in range(3):
        deliver(event(f"e{i}", f"0{i + 1} 10:00:00"))
    staged, posts, users = tables(tmp_path)
    source = streams.read_stream(spark, f"{tmp_path}/source", SCHEMA, max_files=1)
    writer = streams.build_daily_tables(source, staged, posts, users)
    query = streams.run_available(writer, f"{tmp_path}/progress")
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert staged.read(spark).count() == users.read(spark).count() == 3


def test_duplicates_within_the_delay_are_dropped(spark, tmp_path, deliver):
    deliver(event("a", "01 10:00:00"), event("a", "01 10:20:00"), event("b", "01 10:30:00"))
    source = streams.read_stream(spark, f"{tmp_path}/source", SCHEMA)
    once = streams.deduplicated(source, "created_at", dt.timedelta(hours=1))
    writer = once.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    streams.run_available(writer, f"{tmp_path}/progress")
    deliver(event("a", "01 10:40:00"), event("c", "01 10:50:00"))
    streams.run_available(writer, f"{tmp_path}/progress")
    out = spark.read.schema(once.schema).parquet(f"{tmp_path}/out")
    assert rows(out, "event_id") == [("a",), ("b",), ("c",)]


def test_sessions_are_emitted_when_closed(spark, tmp_path, deliver):
    first = [event("a", "01 10:00:00"), event("b", "01 10:30:00"), event("c", "01 12:00:00")]
    deliver(*first)
    source = streams.read_stream(spark, f"{tmp_path}/source", SCHEMA)
    found = streams.stream_sessions(source, "user_id", "created_at", dt.timedelta(minutes=10))
    writer = found.writeStream.format("parquet").option("path", f"{tmp_path}/out")

    def run():
        streams.run_available(writer, f"{tmp_path}/progress")
        return rows(spark.read.schema(found.schema).parquet(f"{tmp_path}/out"))

    batch = rows(viewer_sessions(stg_events(table(spark, EVENT, *first))))
    assert run() == batch[:1]
    more = [event("d", "01 12:10:00"), event("e", "01 14:00:00")]
    deliver(*more)
    batch = rows(viewer_sessions(stg_events(table(spark, EVENT, *first, *more))))
    assert run() == batch[:2] and len(batch) == 3


def test_open_sessions_are_those_of_the_state(spark, tmp_path, deliver):
    (tmp_path / "source").mkdir()
    source = streams.read_stream(spark, f"{tmp_path}/source", SCHEMA)
    found = streams.stream_sessions(source, "user_id", "created_at", dt.timedelta(minutes=10))
    writer = found.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    events = []
    for more in (
        [event("a", "01 10:00:00"), event("b", "01 12:00:00"), event("v", "01 11:55:00", user=None)],
        [event("c", "01 12:20:00"), event("d", "01 12:25:00", user="v")],
        [event("e", "01 15:00:00", user="w")],
    ):
        events += more
        deliver(*more)
        streams.run_available(writer, f"{tmp_path}/progress")
        emitted = spark.read.schema(found.schema).parquet(f"{tmp_path}/out")
        still_open = streams.open_sessions(spark, f"{tmp_path}/progress", "user_id")
        assert still_open.columns == found.columns
        # Nothing but the state is read.
        assert "source" not in still_open._jdf.queryExecution().toString()
        batch = viewer_sessions(stg_events(table(spark, EVENT, *events)))
        assert rows(emitted.unionByName(still_open)) == rows(batch.select(found.columns))
    assert rows(still_open) == [("w", dt.datetime(2100, 1, 1, 15), dt.datetime(2100, 1, 1, 15), 1)]


def test_a_single_file_can_be_the_source(spark, tmp_path):
    table(spark, EVENT, event("a", "01 10:00:00")).coalesce(1).write.parquet(f"{tmp_path}/x")
    file = next((tmp_path / "x").glob("*.parquet"))
    source = streams.read_stream(spark, str(file), SCHEMA)
    writer = source.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    streams.run_available(writer, f"{tmp_path}/progress")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
