import datetime as dt
from pathlib import Path

import pytest
from helpers import at, day, rows, table
from pyspark.sql import functions as F

from tidemark.operators import incremental as inc
from tidemark.operators import keyindex
from tidemark.operators.incremental import IncrementalTable
from tidemark.plans.metrics import agg_post_metrics_daily
from tidemark.plans.staging import stg_events
from tidemark.sources import notes, paths

EVENT = "event_id string, user_id string, post_id string, created_at timestamp_ntz, event_type string"


def event(name, time, kind="view", post="p", user="u"):
    return (name, user, post, f"2100-01-{time}", kind)


def raw(spark, *events):
    return table(spark, EVENT, *events)


@pytest.fixture
def staged(tmp_path):
    return IncrementalTable(f"{tmp_path}/stg", ("event_id",), "partition_date")


@pytest.fixture
def daily(tmp_path):
    return IncrementalTable(f"{tmp_path}/agg", ("event_date", "post_id"), "event_date")


def load(spark, staged, *events, **options):
    inc.load_new_rows(raw(spark, *events), staged, "created_at", stg_events, **options)
    return content(spark, staged)


def content(spark, staged):
    return [
        (name, str(time), str(date))
        for name, time, date in rows(staged.read(spark), "event_id", "created_at", "partition_date")
    ]


def names(found):
    return [name for name, *_ in found]


def test_first_run_loads_all_and_later_runs_only_newer_rows(spark, staged):
    assert not staged.exists(spark)
    assert inc.high_watermark(spark, staged, "created_at") is None
    assert names(load(spark, staged, event("a", "01 10:00:00"), event("b", "02 10:00:00"))) == ["a", "b"]
    assert inc.latest_day(spark, staged) == day("2100-01-02")
    assert inc.high_watermark(spark, staged, "created_at") == at("2100-01-02 10:00:00")
    found = load(
        spark,
        staged,
        event("tie", "02 10:00:00"),
        event("late", "01 23:00:00"),
        event("new", "02 10:00:00.000001"),
        event("next", "03 00:00:00"),
    )
    # The rows of the day the batch touches are kept.
    assert names(found) == ["a", "b", "new", "next"]
    assert inc.high_watermark(spark, staged, "created_at") == at("2100-01-03 00:00:00")


def test_lookback_takes_late_rows_and_replaces_known_ones(spark, staged):
    first = [event("a", "01 10:00:00"), event("b", "02 10:00:00")]
    load(spark, staged, *first)
    again = [*first, event("late", "02 09:00:00"), event("too late", "01 09:00:00")]
    found = load(spark, staged, *again, lookback=dt.timedelta(hours=2))
    assert names(found) == ["a", "b", "late"]


@pytest.mark.parametrize("broadcast_keys", [0, 100])
def test_event_sent_again_leaves_its_old_day(spark, staged, monkeypatch, broadcast_keys):
    monkeypatch.setattr(inc, "BROADCAST_KEYS", broadcast_keys)
    load(spark, staged, event("a", "01 10:00:00"), event("b", "01 11:00:00"), event("c", "02 10:00:00"))
    found = load(spark, staged, event("a", "03 10:00:00"))
    assert found == [
        ("a", "2100-01-03 10:00:00", "2100-01-03"),
        ("b", "2100-01-01 11:00:00", "2100-01-01"),
        ("c", "2100-01-02 10:00:00", "2100-01-02"),
    ]


def test_day_that_loses_its_last_row_is_emptied(spark, staged):
    load(spark, staged, event("a", "01 10:00:00"), event("c", "02 10:00:00"))
    found = load(spark, staged, event("a", "03 10:00:00"), event("c", "03 11:00:00"))
    assert [(n, d) for n, _, d in found] == [("a", "2100-01-03"), ("c", "2100-01-03")]
    # Emptied days are passed over when the newest one is looked for.
    inc.delete_insert(stg_events(raw(spark, event("a", "02 10:00:00"), event("c", "02 11:00:00"))), staged)
    assert inc.latest_day(spark, staged) == day("2100-01-02")


def test_event_without_a_time_has_a_place_and_can_get_a_time(spark, staged):
    def send(*events):
        inc.delete_insert(stg_events(raw(spark, *events)), staged)
        return sorted((n, d) for n, _, d in content(spark, staged))

    untimed = ("x", "u", "p", None, "view")
    load(spark, staged, event("a", "01 10:00:00"))
    assert send(untimed) == [("a", "2100-01-01"), ("x", "None")]
    assert inc.latest_day(spark, staged) == day("2100-01-01")
    assert send(untimed, event("b", "02 10:00:00"))[-1] == ("x", "None")
    assert send(event("x", "02 11:00:00")) == [
        ("a", "2100-01-01"),
        ("b", "2100-01-02"),
        ("x", "2100-01-02"),
    ]
    assert inc.high_watermark(spark, staged, "created_at") == at("2100-01-02 11:00:00")


def test_duplicate_ids_of_one_batch_are_both_inserted(spark, staged):
    load(spark, staged, event("a", "01 10:00:00"))
    assert names(load(spark, staged, event("b", "02 10:00:00"), event("b", "02 11:00:00"))) == ["a", "b", "b"]


def test_empty_target_is_loaded_in_full(spark, staged):
    inc.full_refresh(stg_events(raw(spark, event("x", "05 10:00:00"))), staged)
    nothing = staged.read(spark).drop("partition_date").limit(0)
    nothing.write.mode("overwrite").parquet(f"{staged.folder(spark)}/partition_date=2100-01-05")
    assert staged.exists(spark) and inc.high_watermark(spark, staged, "created_at") is None
    assert names(load(spark, staged, event("a", "01 10:00:00"))) == ["a"]


def test_empty_batch_changes_nothing(spark, staged):
    before = load(spark, staged, event("a", "01 10:00:00"))
    assert load(spark, staged, event("tie", "01 10:00:00")) == before


def test_full_refresh_starts_over(spark, staged):
    load(spark, staged, event("a", "01 10:00:00"), event("b", "02 10:00:00"))
    assert names(load(spark, staged, event("a", "01 10:00:00"), refresh=True)) == ["a"]


def test_run_that_broke_off_between_two_days_is_repaired(spark, staged, monkeypatch):
    load(spark, staged, event("a", "01 10:00:00"))
    batch = [event("a", "01 10:00:00"), event("b", "02 10:00:00"), event("c", "03 10:00:00")]

    def newest_day_only(update, table):
        some = update.content.where("partition_date = date'2100-01-03'")
        inc._write(some, table, table.folder(spark), "dynamic")
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(inc, "replace_days", newest_day_only)
        with pytest.raises(RuntimeError):
            load(spark, staged, *batch)
    assert names(content(spark, staged)) == ["a", "c"]
    # By the watermark alone b would be too old now.
    assert names(load(spark, staged, *batch)) == ["a", "b", "c"]
    assert names(load(spark, staged, *batch, event("late", "02 11:00:00"))) == ["a", "b", "c"]


def test_recent_days_are_aggregated_again(spark, staged, daily):
    def refresh():
        inc.recompute_recent_days(
            staged.read(spark), daily, "partition_date", agg_post_metrics_daily
        )
        return [(str(d), p, n, v) for d, p, n, v in rows(daily.read(spark), "event_date", "post_id", "likes", "views")]

    load(spark, staged, event("a", "01 10:00:00"), event("b", "02 10:00:00"))
    assert refresh() == [("2100-01-01", "p", 0, 1), ("2100-01-02", "p", 0, 1)]
    load(
        spark,
        staged,
        event("c", "02 11:00:00", "like"),
        event("d", "02 12:00:00", "like", "q"),
        event("e", "03 10:00:00", user="v"),
    )
    assert refresh() == [
        ("2100-01-01", "p", 0, 1),
        ("2100-01-02", "p", 1, 1),
        ("2100-01-02", "q", 1, 0),
        ("2100-01-03", "p", 0, 1),
    ]
    # An event that moves away from an older day does not reach that day's metrics.
    load(spark, staged, event("a", "03 11:00:00"))
    assert refresh()[0] == ("2100-01-01", "p", 0, 1)


def test_watermark_filter_prunes_partitions(spark, staged, capsys):
    load(spark, staged, event("a", "01 10:00:00"), event("b", "02 10:00:00"))
    inc.since_day(staged.read(spark), "partition_date", day("2100-01-02")).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(partition_date" in plan


def test_a_batch_looks_at_the_days_of_its_ids_only(spark, staged, monkeypatch):
    events = [event(str(i), f"{1 + i % 9:02d} 10:00:00") for i in range(90)]
    load(spark, staged, *events)
    read, looked = IncrementalTable.read_days, []

    def read_days(self, session, days):
        looked.append(set(days))
        return read(self, session, days)

    def whole(self, session):
        raise AssertionError("all days are read")

    monkeypatch.setattr(IncrementalTable, "read_days", read_days)
    again = stg_events(raw(spark, event("3", "12 10:00:00"), event("13", "12 11:00:00")))
    with monkeypatch.context() as patched:
        patched.setattr(IncrementalTable, "read", whole)
        changed = inc.delete_insert(again, staged)
    moved = {day("2100-01-04"), day("2100-01-05")}
    assert changed == moved | {day("2100-01-12")}
    assert looked[0] == moved
    found = {name: date for name, _, date in content(spark, staged)}
    assert len(found) == 90 and found["3"] == found["13"] == "2100-01-12"


def test_a_table_without_an_index_is_searched_as_a_whole(spark, staged):
    load(spark, staged, event("a", "01 10:00:00"), event("b", "02 10:00:00"))
    index = staged.index(spark).path
    paths.remove(spark, index)
    assert names(load(spark, staged, event("a", "03 10:00:00"))) == ["a", "b"]
    assert not paths.exists(spark, index)


def files(folder):
    return [f for f in Path(folder).rglob("*.parquet")]


def test_the_index_has_few_files_after_many_batches(spark, staged):
    events = [event(str(i), f"{1 + i % 3:02d} 10:00:00") for i in range(30)]
    load(spark, staged, *events)
    index = staged.index(spark)
    for n in range(10):
        batch = [event(f"{n}-{i}", f"{4 + n:02d} 10:00:00") for i in range(5)]
        inc.delete_insert(stg_events(raw(spark, *batch)), staged)
        # One file a batch, and runs of like size are folded.
        assert len(files(index.path)) <= 2 * keyindex.FOLD
    assert len(index.runs(spark)) < keyindex.FOLD and sum(r.rows for r in index.runs(spark)) == 80
    keys = spark.createDataFrame([("3",), ("0-1",), ("9-4",), ("new",)], "event_id string")
    assert index.days_of(keys, 4) == {day("2100-01-01"), day("2100-01-04"), day("2100-01-13")}


@pytest.mark.parametrize("count", [4, 4000])
def test_buckets_follow_the_size_of_a_run(spark, tmp_path, monkeypatch, count):
    monkeypatch.setattr(keyindex, "BUCKET_ROWS", 100)
    index = keyindex.KeyIndex(f"{tmp_path}/index", ("id",), "day")
    rows_ = spark.range(5000).selectExpr("cast(id as string) id", "date_add(date'2100-01-01', cast(id % 50 as int)) day")
    index.add(rows_, 5000)
    index.add(rows_.limit(30), 30)
    big, small = index.runs(spark)
    assert (big.buckets, small.buckets) == (50, 1) and len(files(index.path)) == 51
    # Few keys read the buckets they fall into, many read all.
    keys = rows_.where(f"id < {count}").limit(count).select("id")
    read = index.entries(keys, count).inputFiles()
    assert (len(read) <= 5) if count == 4 else (len(read) == 51)
    assert len(index.days_of(keys, count)) == min(count, 50)


def test_runs_are_folded_into_larger_ones_without_loss(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "BUCKET_ROWS", 64)
    monkeypatch.setattr(keyindex, "FOLD", 3)
    index = keyindex.KeyIndex(f"{tmp_path}/index", ("id",), "day")
    for n in range(10):
        index.add(
            spark.range(n * 9, n * 9 + 10).selectExpr("id", "date'2100-01-01' as day"), 10
        )
    assert len(index.runs(spark)) <= 4
    found = index.entries(spark.range(100), 100)
    assert found.select("id").distinct().count() == 91
    again = keyindex.KeyIndex(f"{tmp_path}/index", ("id",), "day")
    assert again.days_of(spark.range(95, 99), 4) == set()


def test_days_outlive_every_break_of_a_note(spark, staged, monkeypatch):
    load(spark, staged, event("a", "01 10:00:00"))
    inc.days_followed(spark, staged)
    load(spark, staged, event("b", "02 10:00:00"))

    def broken(*_):
        raise RuntimeError("lost the driver")

    # While the next note is written, and right after it.
    for module, name in ((notes.paths, "write_text"), (inc, "replace_days")):
        with monkeypatch.context() as patch:
            patch.setattr(module, name, broken)
            with pytest.raises(RuntimeError):
                inc.delete_insert(stg_events(raw(spark, event("c", "03 10:00:00"))), staged)
        assert day("2100-01-02") in inc.changed_days(spark, staged)
    inc.delete_insert(stg_events(raw(spark, event("c", "03 10:00:00"))), staged)
    assert inc.changed_days(spark, staged) == {day("2100-01-02"), day("2100-01-03")}
    # While days are followed another one changes: it stays noted.
    inc.days_followed(spark, staged, frozenset({day("2100-01-02")}))
    assert inc.changed_days(spark, staged) == {day("2100-01-03")}
    # While notes are dropped.
    inc.note_days(spark, staged, frozenset({day("2100-01-04")}))
    drop, dropped = notes.paths.remove, []

    def once(session, path):
        if dropped:
            raise RuntimeError("lost the driver")
        dropped.append(path)
        drop(session, path)

    with monkeypatch.context() as patch:
        patch.setattr(notes.paths, "remove", once)
        with pytest.raises(RuntimeError):
            inc.days_followed(spark, staged)
    # The notes that were not dropped yet are followed once more.
    assert inc.changed_days(spark, staged) == {day("2100-01-03"), day("2100-01-04")}


def test_notes_of_a_table_that_nothing_follows_are_merged(spark, staged, monkeypatch):
    monkeypatch.setattr(inc, "MANY_NOTES", 4)
    load(spark, staged, event("a", "01 10:00:00"))
    inc.days_followed(spark, staged)
    for n in range(2, 12):
        inc.note_days(spark, staged, frozenset({day(f"2100-01-{n:02d}"), None}))
    assert len(notes.read(spark, f"{staged.path}/_changed")) <= 5
    assert inc.changed_days(spark, staged) == {None, *(day(f"2100-01-{n:02d}") for n in range(2, 12))}
    inc.note_days(spark, staged, None)
    assert inc.changed_days(spark, staged) is None


def test_a_failed_refresh_leaves_the_old_rows(spark, staged):
    before = load(spark, staged, event("a", "01 10:00:00"), event("b", "02 10:00:00"))
    held = staged.read(spark)
    failing = stg_events(raw(spark, event("c", "03 10:00:00"))).withColumn(
        "user_id", F.raise_error(F.lit("lost an executor"))
    )
    with pytest.raises(Exception, match="lost an executor"):
        inc.full_refresh(failing, staged)
    assert content(spark, staged) == before
    # The days are followed as a whole, for nothing; the next refresh counts.
    assert inc.changed_days(spark, staged) is None
    assert names(load(spark, staged, event("c", "03 10:00:00"), refresh=True)) == ["c"]
    # Who read the version before still can.
    assert held.count() == 2
    assert load(spark, staged, event("d", "04 10:00:00"))[-1][0] == "d"
    assert inc.high_watermark(spark, staged, "created_at") == at("2100-01-04 10:00:00")


def test_a_refresh_may_read_the_table_itself(spark, staged):
    load(spark, staged, event("a", "01 10:00:00"), event("b", "02 10:00:00"))
    inc.full_refresh(staged.read(spark).where("event_id = 'b'"), staged)
    assert names(content(spark, staged)) == ["b"]
    for _ in range(3):
        inc.full_refresh(staged.read(spark), staged)
    assert len([n for n in paths.names(spark, staged.path) if n.startswith("v=")]) == 2


def test_planning_opens_no_file(spark, staged):
    load(spark, staged, event("a", "01 10:00:00"))
    jobs = spark.sparkContext._jsc.sc().dagScheduler()
    before = jobs.nextJobId()
    assert staged.read(spark).columns[-1] == "partition_date"
    assert dict(staged.read_days(spark, {day("2100-01-01")}).dtypes)["partition_date"] == "date"
    assert jobs.nextJobId() == before
