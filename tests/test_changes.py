from helpers import at, day, rows, table
from pyspark.sql import functions as F

from tidemark.operators import changes as ch

STATE = (
    "user_id string, name string, colour string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, deleted_at timestamp_ntz"
)
T = {n: f"2100-01-0{n} 12:00:00" for n in range(1, 9)}


def state(spark, *rows_):
    return table(spark, STATE, *rows_)


def batch(spark, *rows_):
    """Rows of (key, type, changed_at, set columns, name, colour)."""
    columns = (
        "user_id string, change_type string, changed_at timestamp_ntz, sets string, "
        "name string, colour string"
    )
    raw = table(spark, columns, *rows_)
    return raw.withColumn("set_columns", F.split("sets", ",")).withColumn(
        "created_at", F.col("changed_at")
    )


def merged(spark, state_, *changes):
    return ch.merge_changes(state_, batch(spark, *changes), "user_id", ["name", "colour"])


def test_update_sets_named_columns_only_and_may_set_null(spark):
    before = state(spark, ("a", "x", "red", T[1], T[1], None), ("b", "x", "red", T[1], T[1], None))
    after = merged(
        spark,
        before,
        ("a", "update", T[2], "name", "y", None),
        ("b", "update", T[2], "colour", None, None),
    )
    assert rows(after, "user_id", "name", "colour", "updated_at", "applied") == [
        ("a", "y", "red", at(T[2]), "updated"),
        ("b", "x", None, at(T[2]), "updated"),
    ]


def test_several_updates_of_a_key_fold_by_time(spark):
    before = state(spark, ("a", "x", "red", T[1], T[1], None))
    after = merged(
        spark,
        before,
        ("a", "update", T[3], "name", "late", None),
        ("a", "update", T[2], "name,colour", "early", "blue"),
    )
    assert rows(after, "name", "colour", "updated_at") == [("late", "blue", at(T[3]))]


def test_delete_is_soft_and_comes_before_updates(spark):
    before = state(spark, ("a", "x", "red", T[1], T[1], None))
    after = merged(
        spark, before, ("a", "update", T[2], "name", "y", None), ("a", "delete", T[3], None, None, None)
    )
    assert rows(after, "name", "updated_at", "deleted_at", "applied") == [
        ("x", at(T[3]), at(T[3]), "deleted")
    ]


def test_deleted_rows_are_not_touched(spark):
    before = state(spark, ("a", "x", "red", T[1], T[2], T[2]))
    after = merged(
        spark,
        before,
        ("a", "update", T[3], "name", "y", None),
        ("a", "delete", T[4], None, None, None),
    )
    assert rows(after.drop("applied")) == rows(before)
    assert rows(after, "applied") == [(None,)]


def test_insert_adds_unknown_keys_once(spark):
    before = state(spark, ("a", "x", "red", T[1], T[1], None))
    change = [("a", "insert", T[2], None, "y", "blue"), ("b", "insert", T[2], None, "y", "blue")]
    after = merged(spark, before, *change)
    expected = [
        ("a", "x", "red", at(T[1]), at(T[1]), None),
        ("b", "y", "blue", at(T[2]), at(T[2]), None),
    ]
    assert rows(after.drop("applied")) == expected
    assert rows(merged(spark, after.drop("applied"), *change), "applied") == [(None,), (None,)]


def test_changes_of_unknown_keys_are_ignored(spark):
    before = state(spark, ("a", "x", "red", T[1], T[1], None))
    after = merged(
        spark, before, ("z", "update", T[2], "name", "y", None), ("y", "delete", T[2], None, None, None)
    )
    assert rows(after, "user_id") == [("a",)]


def test_audit_counts_rows_that_changed(spark):
    before = state(spark, *[(k, "x", "red", T[1], T[1], None) for k in "abc"])
    after = merged(
        spark,
        before,
        ("a", "delete", T[2], None, None, None),
        ("a", "update", T[2], "name", "y", None),
        ("b", "update", T[2], "name", "y", None),
        ("z", "delete", T[2], None, None, None),
        ("n", "insert", T[2], None, "y", None),
    )
    audit = ch.audit_row(after, "user", F.lit(day("2100-01-02")), F.localtimestamp())
    assert rows(audit.drop("real_timestamp")) == [(day("2100-01-02"), "user", 1, 1, 1)]


def test_summary_and_next_job_date(spark):
    users = state(spark, ("a", "x", "r", T[1], T[1], None), ("b", "x", "r", T[1], T[1], T[1]))
    events = spark.range(5)
    assert rows(ch.live_row_summary({"user": users, "event": events})) == [
        ("event", 5, 5, 0),
        ("user", 2, 1, 1),
    ]
    audit = table(spark, "ingest_date date", ("2100-01-04",), ("2100-01-31",))
    first = F.lit(day("2100-01-01"))
    assert rows(ch.next_job_date(audit, first)) == [(day("2100-02-01"),)]
    assert rows(ch.next_job_date(audit.where("false"), first)) == [(day("2100-01-01"),)]
