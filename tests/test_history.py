import random

import pytest
from helpers import rows, table

from tidemark.operators import intervals
from tidemark.operators.intervals import (
    close_intervals,
    history_from_feed,
    history_from_runs,
    last_per_group,
)
from tidemark.operators.snapshots import snapshot_run
from tidemark.schemas import timestamp
from pyspark.sql import functions as F

SOURCE = "k string, name string, metric int, updated_at timestamp_ntz, created_at timestamp_ntz"
SHOW = ("k", "name", "metric", "valid_from", "valid_to")
OPEN = "9999-12-31 00:00:00"
D = {n: f"2100-01-0{n} 12:00:00" for n in range(1, 9)}


def source(spark, *rows_):
    return table(spark, SOURCE, *[(k, name, m, D[t], D[1]) for k, name, m, t in rows_])


def shown(history, *extra):
    text = [F.col(f"dbt_{c}").cast("string").alias(c) for c in ("valid_from", "valid_to")]
    return rows(history.select("*", *text), *SHOW, *extra)


def run(history, source_, ts=None, **options):
    at = timestamp(ts) if ts else None
    return snapshot_run(history, source_, "k", "updated_at", at, **options)


def test_new_changed_and_unchanged_keys(spark):
    first = run(None, source(spark, ("same", "a", 1, 1), ("changed", "a", 1, 1)))
    assert shown(first) == [("changed", "a", 1, D[1], OPEN), ("same", "a", 1, D[1], OPEN)]
    second = run(first, source(spark, ("same", "a", 1, 1), ("changed", "b", 2, 2), ("new", "c", 3, 2)))
    expected = [
        ("changed", "a", 1, D[1], D[2]),
        ("changed", "b", 2, D[2], OPEN),
        ("new", "c", 3, D[2], OPEN),
        ("same", "a", 1, D[1], OPEN),
    ]
    assert shown(second) == expected
    # The same run again changes nothing, and closed versions stay as they are.
    again = run(second, source(spark, ("same", "a", 1, 1), ("changed", "b", 2, 2), ("new", "c", 3, 2)))
    assert shown(again) == expected
    assert again.select("dbt_scd_id").distinct().count() == 4
    assert again.where("dbt_updated_at <> dbt_valid_from").isEmpty()


def test_a_change_that_leaves_updated_at_alone_opens_nothing(spark):
    first = run(None, source(spark, ("a", "x", 1, 1)))
    assert shown(run(first, source(spark, ("a", "x", 99, 1)))) == [("a", "x", 1, D[1], OPEN)]


def test_older_updated_at_opens_nothing(spark):
    first = run(None, source(spark, ("a", "x", 1, 2)))
    assert shown(run(first, source(spark, ("a", "y", 1, 1)))) == [("a", "x", 1, D[2], OPEN)]


def test_missing_key_keeps_its_version_by_default(spark):
    first = run(None, source(spark, ("a", "x", 1, 1)))
    assert shown(run(first, source(spark))) == [("a", "x", 1, D[1], OPEN)]


def test_deletion_record_and_return(spark):
    options = {"hard_deletes": "new_record"}
    first = run(None, source(spark, ("a", "x", 1, 1), ("b", "x", 1, 1)), D[1], **options)
    gone = run(first, source(spark, ("b", "x", 1, 1)), D[3], **options)
    deleted = [
        ("a", "x", 1, D[1], D[3], "False"),
        ("a", "x", 1, D[3], OPEN, "True"),
        ("b", "x", 1, D[1], OPEN, "False"),
    ]
    assert shown(gone, "dbt_is_deleted") == deleted
    still = run(gone, source(spark, ("b", "x", 1, 1)), D[4], **options)
    assert shown(still, "dbt_is_deleted") == deleted

    back = run(still, source(spark, ("a", "y", 2, 5), ("b", "x", 1, 1)), D[6], **options)
    assert [r for r in shown(back, "dbt_is_deleted") if r[0] == "a"] == [
        ("a", "x", 1, D[1], D[3], "False"),
        ("a", "x", 1, D[3], D[5], "True"),
        ("a", "y", 2, D[5], OPEN, "False"),
    ]
    # A key that returns unchanged opens at the run, not before its deletion.
    same = run(still, source(spark, ("a", "x", 1, 1), ("b", "x", 1, 1)), D[6], **options)
    assert [r for r in shown(same, "dbt_is_deleted") if r[0] == "a"] == [
        ("a", "x", 1, D[1], D[3], "False"),
        ("a", "x", 1, D[3], D[6], "True"),
        ("a", "x", 1, D[6], OPEN, "False"),
    ]
    # And that version is unchanged at the next run.
    later = run(same, source(spark, ("a", "x", 1, 1), ("b", "x", 1, 1)), D[7], **options)
    assert shown(later) == shown(same)


def test_first_version_may_begin_at_creation(spark):
    options = {"initial_valid_from": "created_at"}
    first = run(None, source(spark, ("a", "x", 1, 2)), **options)
    assert shown(first) == [("a", "x", 1, D[1], OPEN)]
    second = run(first, source(spark, ("a", "y", 1, 3), ("b", "x", 1, 3)), **options)
    assert shown(second) == [
        ("a", "x", 1, D[1], D[3]),
        ("a", "y", 1, D[3], OPEN),
        ("b", "x", 1, D[1], OPEN),
    ]


def test_wrong_options(spark):
    empty = source(spark)
    with pytest.raises(ValueError):
        run(None, empty, hard_deletes="other")
    with pytest.raises(ValueError):
        run(None, empty, hard_deletes="new_record")


FEED = "k string, updated_at timestamp_ntz, name string, id int"


def feed_of(spark, seed=3):
    rng = random.Random(seed)
    changes = []
    for i in range(300):
        key = "hot" if i % 2 else f"k{rng.randrange(12)}"
        minute = rng.randrange(6 * 1440)
        time = f"2100-01-{1 + minute // 1440:02d} {minute // 60 % 24:02d}:{minute % 60:02d}:00"
        changes.append((key, time, f"n{i}", i))
    return changes, table(spark, FEED, *changes)


def versions_of(history):
    return rows(
        history.select(
            "k",
            "name",
            F.col("dbt_valid_from").cast("string"),
            F.col("dbt_valid_to").cast("string"),
        )
    )


def expected_versions(changes, run_of=lambda time: time):
    last = {}
    for key, time, name, i in sorted(changes, key=lambda c: (c[1], c[3])):
        last[key, run_of(time)] = (key, time, name)
    found = []
    for key in {k for k, _ in last}:
        own = sorted((t, n) for k, t, n in last.values() if k == key)
        ends = [t for t, _ in own[1:]] + [OPEN]
        found += [(key, n, t, e) for (t, n), e in zip(own, ends)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("rows_per_group", [None, 5, 1000])
def test_history_from_a_feed(spark, rows_per_group):
    changes, feed = feed_of(spark)
    history = history_from_feed(feed, "k", "updated_at", "id", rows_per_group)
    assert versions_of(history) == expected_versions(changes)
    assert history.where("dbt_valid_from >= dbt_valid_to").isEmpty()
    per_key = history.groupBy("k").agg(F.count_if(F.year("dbt_valid_to") == 9999).alias("n"))
    assert per_key.where("n <> 1").isEmpty()


@pytest.mark.parametrize("rows_per_group", [None, 5])
def test_runs_in_bulk_and_one_by_one_agree(spark, rows_per_group):
    changes, feed = feed_of(spark, 4)
    day = F.to_date("updated_at")
    bulk = history_from_runs(feed, "k", "updated_at", day, "id", rows_per_group)
    assert versions_of(bulk) == expected_versions(changes, lambda time: time[:10])
    history = None
    for n in range(2, 8):
        seen = feed.where(F.col("updated_at") < timestamp(f"2100-01-0{n} 00:00:00"))
        state = last_per_group(seen, ["k"], ["updated_at", "id"])
        history = snapshot_run(history, state, "k", "updated_at").checkpoint()
    assert versions_of(history) == versions_of(bulk)


def test_last_change_of_one_instant_counts(spark):
    feed = table(spark, FEED, ("a", D[1], "old", 1), ("a", D[1], "new", 2), ("a", D[1], None, 0))
    assert versions_of(history_from_feed(feed, "k", "updated_at", "id")) == [
        ("a", "new", D[1], OPEN)
    ]


@pytest.mark.parametrize("rows_per_group", [None, 2])
def test_first_versions_may_begin_at_creation(spark, rows_per_group):
    feed = table(
        spark,
        FEED,
        ("a", D[3], "dropped", 0),
        ("a", D[3], "x", 1),
        ("a", "2100-01-03 12:30:00", "same hour", 2),
        ("a", D[5], "y", 3),
        ("a", "2100-01-05 12:30:00", "z", 4),
        ("b", D[1], "created later", 5),
    ).withColumn("born", timestamp(D[2]))
    history = close_intervals(feed, "k", "updated_at", "id", rows_per_group, "born")
    assert versions_of(history) == [
        ("a", "same hour", "2100-01-03 12:30:00", D[5]),
        ("a", "x", D[2], "2100-01-03 12:30:00"),
        ("a", "y", D[5], "2100-01-05 12:30:00"),
        ("a", "z", "2100-01-05 12:30:00", OPEN),
        ("b", "created later", D[1], OPEN),
    ]


def model_run(history, state, run_ts, record):
    """The rules of one run, row by row. Versions are [key, name, from, to, deleted]."""
    result = [list(v) for v in history]
    current = {v[0]: v for v in result if v[3] == OPEN}
    for key, (name, updated) in state.items():
        old = current.get(key)
        if old is None:
            result.append([key, name, updated, OPEN, "False"])
        elif old[4] == "True":
            opens = updated if updated > old[2] else run_ts
            old[3] = opens
            result.append([key, name, opens, OPEN, "False"])
        elif updated > old[2]:
            old[3] = updated
            result.append([key, name, updated, OPEN, "False"])
    for key, old in current.items():
        if record and key not in state and old[4] == "False":
            old[3] = run_ts
            result.append([key, old[1], run_ts, OPEN, "True"])
    return result


@pytest.mark.parametrize("hard_deletes", ["ignore", "new_record"])
def test_random_runs_follow_the_rules(spark, hard_deletes):
    rng = random.Random(11)
    record = hard_deletes == "new_record"
    expected, history, state = [], None, {}
    for day in range(1, 9):
        for key in (f"k{i}" for i in range(10)):
            move = rng.random()
            if move < 0.25:
                state.pop(key, None)
            elif move < 0.6:
                hour = rng.randrange(24)
                state[key] = (f"n{day}", f"2100-01-{day:02d} {hour:02d}:00:00")
            elif move < 0.7:
                state[key] = (f"n{day}", "2099-12-31 00:00:00")
        run_ts = f"2100-01-{day + 1:02d} 00:00:00"
        source_ = table(
            spark,
            "k string, name string, updated_at timestamp_ntz",
            *[(k, name, updated) for k, (name, updated) in state.items()],
        )
        history = run(history, source_, run_ts, hard_deletes=hard_deletes).checkpoint()
        expected = model_run(expected, state, run_ts, record)
    columns = ["k", "name", *[F.col(f"dbt_valid_{c}").cast("string") for c in ("from", "to")]]
    if record:
        columns.append("dbt_is_deleted")
    assert rows(history, *columns) == sorted([tuple(v[: len(columns)]) for v in expected], key=repr)
    # Versions of a key follow one another without overlap or gap; the last is open.
    for key in {v[0] for v in expected}:
        own = sorted((v[2], v[3]) for v in expected if v[0] == key)
        assert [end for _, end in own] == [start for start, _ in own[1:]] + [OPEN]


@pytest.fixture
def group_sizes(monkeypatch):
    """The rows of the largest group of every window that closes intervals."""
    found, real = [], intervals._lead_within

    def lead_within(df, group, at, order):
        found.append(df.groupBy(*group).count().agg(F.max("count")).first()[0])
        return real(df, group, at, order)

    monkeypatch.setattr(intervals, "_lead_within", lead_within)
    return found


def checked_history(feed, limit):
    """(versions, gaps) of a history; every version ends where the key's next one begins."""
    history = history_from_feed(feed, "k", "updated_at", "id", limit).select("k", "name", "dbt_valid_from", "dbt_valid_to")
    history = history.checkpoint()
    other = history.select("k", F.col("dbt_valid_from").alias("dbt_valid_to"))
    last = F.year("dbt_valid_to") == 9999
    followed = history.where(~last).join(other, ["k", "dbt_valid_to"], "left_semi").count()
    assert followed == history.where(~last).count()
    assert history.where(last).count() == history.select("k").distinct().count()
    assert history.where("dbt_valid_from >= dbt_valid_to").isEmpty()
    return history


def test_many_changes_of_one_instant_meet_in_no_window(spark, group_sizes):
    ties = spark.range(10_000).selectExpr(
        "'hot' as k", "timestamp_ntz'2100-01-02 10:00:00' as updated_at", "concat('n', id) as name", "cast(id as int) id"
    )
    others = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 400)) as k",
        "timestampadd(second, cast(id as int), timestamp_ntz'2100-01-02 12:00:00') as updated_at",
        "concat('m', id) as name", "cast(id as int) id",
    )
    found = checked_history(ties.unionByName(others), 500)
    assert max(group_sizes) <= 500
    assert found.where("k = 'hot'").count() == 1001
    assert rows(found.where("dbt_valid_from < timestamp_ntz'2100-01-02 12:00:00'"), "name") == [("n9999",)]
    first = found.where("k = 'hot'").agg(F.min("dbt_valid_to").cast("string")).first()[0]
    assert first == "2100-01-02 12:00:00"


@pytest.mark.parametrize("apart, limit", [("minute, cast(id * 97 as int)", 300), ("microsecond, id * 3", 1000)])
def test_a_hundred_thousand_stretches_of_one_key(spark, group_sizes, apart, limit):
    """Far apart or close together: stretches of stretches, no group above the limit."""
    feed = spark.range(100_000).selectExpr(
        "if(id % 50 = 0, concat('k', id % 7), if(id % 2 = 0, 'hot', null)) as k",
        f"timestampadd({apart}, timestamp_ntz'2100-01-01 00:00:00') as updated_at",
        "concat('n', id) as name", "cast(id as int) id",
    )
    found = history_from_feed(feed, "k", "updated_at", "id", limit)
    ends = {r[0]: r[1:] for r in found.selectExpr("k", "cast(dbt_valid_from as string) a", "cast(dbt_valid_to as string) b", "name").groupBy("k").agg(F.count("*"), F.count_distinct("a"), F.count_distinct("b"), F.max("b")).collect()}
    assert max(group_sizes) <= limit
    assert len(group_sizes) > 2
    assert ends["hot"] == (48_000, 48_000, 48_000, OPEN) and ends[None] == (50_000, 50_000, 50_000, OPEN)
    checked_history(feed.where("k is not null"), limit)


def test_stretches_below_a_second(spark):
    rng = random.Random(5)
    changes = [("hot", f"2100-01-02 10:00:00.{rng.randrange(10**6):06d}", f"n{i}", i) for i in range(400)]
    changes += [("b", "2100-01-01 00:00:00", "x", 1), ("b", "1960-05-01 00:00:00.000001", "y", 2)]
    found = history_from_feed(table(spark, FEED, *changes), "k", "updated_at", "id", 3)
    shown_ = {(k, n, a) for k, n, a, _ in versions_of(found)}
    last = {}
    for k, t, n, i in sorted(changes, key=lambda c: c[3]):
        last[k, t] = (k, n, t.rstrip("0").rstrip(":.") if "." in t else t)
    assert len(shown_) == len(last) and {n for _, n, _ in shown_} == {n for _, n, _ in last.values()}
