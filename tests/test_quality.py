from helpers import rows, table
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.operators.sampling import random_live_rows
from tidemark.operators.sessions import viewer_sessions
from tidemark.schemas import timestamp


def bad(spark):
    return table(
        spark,
        "id int, parent int, kind string",
        (1, 10, "view"),
        (1, 11, "like"),
        (2, None, "share"),
        (None, 99, None),
        (None, 99, "view"),
    )


def test_failures_per_test(spark):
    assert rows(dq.not_null(bad(spark), "id", "kind")) == [
        ("not_null", "id", 2),
        ("not_null", "kind", 1),
    ]
    assert rows(dq.accepted_values(bad(spark), "kind", ("view", "like"))) == [
        ("accepted_values", "kind", 1)
    ]
    # NULL is neither a duplicate nor an orphan.
    assert rows(dq.duplicate_keys(bad(spark), "id")) == [(1, 2)]
    parents = table(spark, "key int", (10,), (11,))
    assert rows(dq.orphan_keys(bad(spark), "parent", parents, "key")) == [(99, 2)]


def test_suite_runs_all_declared_tests(spark):
    suite = {
        "child": dq.TableTests(
            not_null=("id", "parent"),
            unique=("id",),
            accepted={"kind": ("view", "like")},
            references={"parent": ("parent", "key")},
        ),
        "parent": dq.TableTests(unique=("key",)),
    }
    tables = {"child": bad(spark), "parent": table(spark, "key int", (10,), (11,))}
    assert rows(dq.run_tests(tables, suite)) == [
        ("child", "accepted_values", "kind", 1),
        ("child", "not_null", "id", 2),
        ("child", "not_null", "parent", 1),
        ("child", "relationships", "parent", 2),
        ("child", "unique", "id", 1),
        ("parent", "unique", "key", 0),
    ]


def test_one_shuffle_counts_a_kind_of_key(spark, capsys):
    tables = {
        "child": bad(spark).select("id", F.col("parent").alias("key"), "kind"),
        "other": table(spark, "key bigint", (10,), (12,), (12,)),
        "parent": table(spark, "key int", (10,), (11,), (11,), (None,)),
    }
    suite = {
        "child": dq.TableTests(unique=("id",), references={"key": ("parent", "key")}),
        "other": dq.TableTests(unique=("key",), references={"key": ("parent", "key")}),
        "parent": dq.TableTests(unique=("key",)),
    }
    found = dq.run_tests(tables, suite)
    assert rows(found) == [
        ("child", "relationships", "key", 2),
        ("child", "unique", "id", 1),
        ("other", "relationships", "key", 2),
        ("other", "unique", "key", 1),
        ("parent", "unique", "key", 1),
    ]
    dq.run_tests(tables, suite).explain()
    plan = capsys.readouterr().out
    # Two kinds of keys, and for each the row of its failures.
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange SinglePartition") == 2
    assert "Join" not in plan


def test_the_suite_shuffles_each_kind_of_key_once():
    kinds = dq._key_columns(dq.SUITE)
    assert sorted({column for _, column in kind} for kind in kinds) == sorted([{"user_id"}, {"post_id"}, {"event_id"}])
    assert sum(map(len, kinds)) == 4 + 3 + 3


def test_empty_tables_fail_nothing(spark):
    tables = {"child": bad(spark).where("false"), "parent": table(spark, "key int", (1,)).where("false")}
    suite = {"child": dq.TableTests(not_null=("id",), unique=("id",), references={"parent": ("parent", "key")})}
    assert rows(dq.run_tests(tables, suite), "failures") == [(0,), (0,), (0,)]


def test_number_of_declared_tests():
    assert sum(len(tests) for tests in dq.SUITE.values()) == 47
    assert sum(len(tests.not_null) for tests in dq.SUITE.values()) == 35


def test_sample_takes_live_rows_created_before(spark):
    columns = "user_id int, created_at timestamp_ntz, deleted_at timestamp_ntz"
    day = "2100-01-{:02d} 00:00:00".format
    users = table(spark, columns, *[(i, day(1 + i % 20), day(25) if i % 4 == 0 else None) for i in range(100)])
    picked = random_live_rows(users, "user_id", 10, seed=1)
    assert picked.count() == 10 and picked.where("user_id % 4 = 0").isEmpty()
    assert rows(picked) == rows(random_live_rows(users.repartition(7), "user_id", 10, seed=1))
    assert rows(picked) != rows(random_live_rows(users, "user_id", 10, seed=2))
    early = random_live_rows(users, "user_id", 1000, 1, timestamp(day(3)))
    assert rows(early, "user_id") == sorted(
        [(i,) for i in range(100) if i % 20 < 2 and i % 4], key=repr
    )


def test_sessions_end_at_a_pause_longer_than_the_gap(spark):
    events = table(
        spark,
        "user_id string, created_at timestamp_ntz",
        ("a", "2100-01-01 23:50:00"),
        ("a", "2100-01-02 00:20:00"),
        ("a", "2100-01-02 00:50:00.000001"),
        ("a", "2100-01-02 00:50:00.000001"),
        ("b", "2100-01-01 00:00:00"),
    )
    found = [(u, str(s), str(e), n) for u, s, e, n in rows(viewer_sessions(events))]
    assert found == [
        ("a", "2100-01-01 23:50:00", "2100-01-02 00:20:00", 2),
        ("a", "2100-01-02 00:50:00.000001", "2100-01-02 00:50:00.000001", 2),
        ("b", "2100-01-01 00:00:00", "2100-01-01 00:00:00", 1),
    ]
