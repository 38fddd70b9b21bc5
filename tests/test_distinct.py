"""Sets of days against counts over rows."""

import random

import pytest
from helpers import day, rows, table
from pyspark.sql import functions as F

from tidemark.operators import distinct
from tidemark.plans.analyses import active_users_by, active_users_daily
from tidemark.schemas import VALID_FROM, VALID_TO


@pytest.mark.parametrize("width", [10, 100_000, 2**40])
def test_sets_count_and_merge_exactly(spark, width):
    rng = random.Random(width)
    given = [(rng.choice("abc"), rng.randrange(4), rng.choice([None, rng.randrange(-width, width)])) for _ in range(3000)]
    df = spark.createDataFrame(given, "g string, d int, k long").repartition(5)
    sets = distinct.bitmaps(df, ["g", "d"], "k")
    for groups in (["g", "d"], ["g"], ["d"]):
        expected = df.groupBy(*groups).agg(F.count_distinct("k").alias("n")).where("n > 0")
        assert rows(distinct.distinct_counts(sets, groups, "n"), *groups, "n") == rows(expected, *groups, "n")
    half = distinct.distinct_counts(sets, [(F.col("d") % 2).alias("half")], "n")
    assert rows(half) == rows(df.groupBy((F.col("d") % 2).alias("half")).agg(F.count_distinct("k")))


def test_no_rows(spark):
    none = spark.createDataFrame([], "g string, k long")
    assert distinct.distinct_counts(distinct.bitmaps(none, ["g"], "k"), ["g"], "n").count() == 0


def test_keys_keep_their_numbers(spark, tmp_path):
    numbers = distinct.Numbers(f"{tmp_path}/numbers", "user")
    first = table(spark, "user string", ("a",), ("b",), ("a",), (None,)).repartition(3)
    known = dict(rows(numbers.add(first), "user", "number"))
    assert set(known) == {"a", "b"} and len(set(known.values())) == 2
    more = spark.range(1000).selectExpr("concat('u', id) as user").unionByName(first).repartition(7)
    found = dict(rows(numbers.add(more), "user", "number"))
    assert known.items() <= found.items() and len(found) == len(set(found.values())) == 1002
    assert dict(rows(numbers.add(first), "user", "number")) == found
    events = table(spark, "user string, g string", ("a", "x"), ("b", "x"), ("a", "y"), (None, "y"), ("a", "x"))
    sets = distinct.bitmaps(distinct.numbered(events, numbers.read(spark), "user"), ["g"], "number")
    assert rows(distinct.distinct_counts(sets, ["g"], "n")) == [("x", 2), ("y", 1)]


def test_active_users_of_longer_periods(spark):
    events = table(
        spark,
        "event_id long, user_id long, created_at timestamp_ntz, partition_date date",
        *[(i, i % 7, f"2100-0{1 + i % 5}-1{i % 9} 10:00:00", f"2100-0{1 + i % 5}-1{i % 9}") for i in range(90)],
    )
    versions = table(
        spark, f"user_id long, region string, {VALID_FROM} timestamp_ntz, {VALID_TO} timestamp_ntz",
        *[(u, r, a, b) for u in range(6) for r, a, b in (("x", "2100-01-01", "2100-03-15"), ("y", "2100-03-15", "9999-12-31"))],
    )
    daily = active_users_daily(events, versions)
    joined = events.join(versions, "user_id", "left").where(
        F.col(VALID_FROM).isNull() | ((F.col("created_at") >= F.col(VALID_FROM)) & (F.col("created_at") < F.col(VALID_TO)))
    )
    for period in ("week", "month", "quarter", "year"):
        starts = F.to_date(F.date_trunc(period, "created_at")).alias("starts")
        expected = joined.groupBy(starts, "region").agg(F.count_distinct("user_id").alias("users"))
        assert rows(active_users_by(daily, period), "starts", "region", "users") == rows(expected)
    assert active_users_by(daily, "year", 2101).isEmpty()
    assert rows(active_users_by(daily, "year", 2100), "starts")[0] == (day("2100-01-01"),)
