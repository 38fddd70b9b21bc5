import random

import pytest
from pyspark.sql import functions as F
from helpers import day, rows, table

from tidemark.operators.temporal import temporal_join
from tidemark.plans.analyses import mau_by_region_and_month, mau_from_daily

VERSION = (
    "user_id string, region string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz"
)
FACT = "event_id int, user_id string, created_at timestamp_ntz"
OPEN = "9999-12-31 00:00:00"
METHODS = [
    ("auto", None),
    ("broadcast", None),
    ("range", None),
    ("asof", None),
    ("range", 3),
    ("asof", 3),
]


def joined(facts, versions, method, rows_per_group):
    return temporal_join(
        facts, versions, "user_id", "created_at", ["region"], method, rows_per_group
    )


@pytest.mark.parametrize("method, rows_per_group", METHODS)
def test_half_open_boundaries_gaps_and_missing_versions(spark, method, rows_per_group):
    versions = table(
        spark,
        VERSION,
        ("a", "EU", "2100-01-01 10:00:00", "2100-01-02 10:00:00"),
        ("a", None, "2100-01-02 10:00:00", "2100-01-03 10:00:00"),
        ("a", "AF", "2100-01-04 10:00:00", OPEN),
        ("b", "AS", "2100-01-01 00:00:00", "2100-01-02 00:00:00"),
        (None, "XX", "2100-01-01 00:00:00", OPEN),
    )
    facts = table(
        spark,
        FACT,
        (1, "a", "2100-01-01 09:59:59.999999"),
        (2, "a", "2100-01-01 10:00:00"),
        (3, "a", "2100-01-02 09:59:59.999999"),
        (4, "a", "2100-01-02 10:00:00"),
        (5, "a", "2100-01-03 10:00:00"),
        (6, "a", "2101-06-01 00:00:00"),
        (7, "b", "2100-01-02 00:00:00"),
        (8, "c", "2100-01-02 00:00:00"),
        (9, None, "2100-01-02 00:00:00"),
    )
    result = joined(facts, versions, method, rows_per_group)
    assert result.columns == ["event_id", "user_id", "created_at", "region"]
    assert rows(result, "event_id", "region") == [
        (1, None),
        (2, "EU"),
        (3, "EU"),
        (4, None),
        (5, None),
        (6, "AF"),
        (7, None),
        (8, None),
        (9, None),
    ]


def test_all_plans_agree_on_hot_keys(spark):
    """One user with most facts, one with most versions, many facts in one hour."""
    rng = random.Random(5)

    def time(minutes):
        return f"2100-01-{1 + minutes // 1440:02d} {minutes // 60 % 24:02d}:{minutes % 60:02d}:00"

    versions = []
    for user, count in (("hot", 4), ("moving", 60), *((f"u{i}", 2) for i in range(8))):
        starts = sorted(rng.sample(range(20 * 1440), count))
        ends = [time(s) for s in starts[1:]] + [OPEN]
        versions += [(user, f"r{i}", time(s), e) for i, (s, e) in enumerate(zip(starts, ends))]
    facts = [(i, "hot", time(rng.randrange(20 * 1440))) for i in range(150)]
    facts += [(200 + i, "hot", time(5 * 1440 + rng.randrange(60))) for i in range(100)]
    facts += [(400 + i, f"u{i % 10}", time(rng.randrange(20 * 1440))) for i in range(80)]
    facts += [(600 + i, "moving", time(rng.randrange(20 * 1440))) for i in range(20)]
    facts += [(800 + i, None, time(i)) for i in range(30)]
    fact_table, version_table = table(spark, FACT, *facts), table(spark, VERSION, *versions)

    def brute_force(user, ts):
        return next((r for u, r, s, e in versions if u == user and s <= ts < e), None)

    expected = sorted([(i, brute_force(u, t)) for i, u, t in facts], key=repr)
    for method, rows_per_group in [
        ("broadcast", None),
        ("range", None),
        ("asof", None),
        ("range", 10),
        ("asof", 10),
    ]:
        result = joined(fact_table, version_table, method, rows_per_group)
        assert rows(result, "event_id", "region") == expected, (method, rows_per_group)


def test_unknown_method(spark):
    empty = table(spark, FACT), table(spark, VERSION)
    with pytest.raises(ValueError):
        joined(*empty, "other", None)


def test_empty_sides(spark):
    facts = table(spark, FACT, (1, "a", "2100-01-01 00:00:00"))
    versions = table(spark, VERSION, ("a", "EU", "2100-01-01 00:00:00", OPEN))
    for method in ("auto", "range", "asof"):
        assert rows(joined(facts, versions.where("false"), method, 3), "region") == [(None,)]
        assert rows(joined(facts.where("false"), versions, method, 3)) == []


def facts_of(spark, *pairs):
    from tidemark.plans.staging import stg_events

    named = [(str(i), u, "p", t, "view") for i, (u, t) in enumerate(pairs)]
    columns = "event_id string, user_id string, post_id string, created_at timestamp_ntz, event_type string"
    return stg_events(table(spark, columns, *named))


@pytest.mark.parametrize("method, rows_per_group", METHODS)
def test_monthly_users_by_region(spark, method, rows_per_group):
    versions = table(
        spark,
        VERSION,
        ("moves", "EU", "2100-01-01 00:00:00", "2100-01-15 00:00:00"),
        ("moves", "AF", "2100-01-15 00:00:00", OPEN),
        ("stays", "EU", "2099-01-01 00:00:00", OPEN),
        ("late", "EU", "2100-01-20 00:00:00", OPEN),
    )
    facts = facts_of(
        spark,
        ("moves", "2100-01-02 00:00:00"),
        ("moves", "2100-01-31 23:59:59.999999"),
        ("moves", "2100-02-01 00:00:00"),
        ("stays", "2100-01-02 00:00:00"),
        ("stays", "2100-01-03 00:00:00"),
        ("stays", "2099-12-31 23:59:59.999999"),
        ("stays", "2101-01-01 00:00:00"),
        ("late", "2100-01-10 00:00:00"),
    )
    result = mau_by_region_and_month(facts, versions, 2100, method, rows_per_group)
    january, february = day("2100-01-01"), day("2100-02-01")
    assert [tuple(r) for r in result.collect()] == [
        (february, "AF", 1),
        (january, "EU", 2),
        (january, None, 1),
        (january, "AF", 1),
    ]


def test_daily_table_takes_the_region_at_day_end(spark):
    versions = table(
        spark,
        VERSION,
        ("a", "EU", "2100-01-01 00:00:00", "2100-01-02 12:00:00"),
        ("a", "AF", "2100-01-02 12:00:00", OPEN),
    )
    daily = table(
        spark,
        "event_date date, user_id string",
        ("2100-01-01", "a"),
        ("2100-01-02", "a"),
        ("2101-01-01", "a"),
    )
    assert rows(mau_from_daily(daily, versions, 2100)) == [
        (day("2100-01-01"), "AF", 1),
        (day("2100-01-01"), "EU", 1),
    ]


def test_plan_follows_the_number_of_versions(spark, monkeypatch):
    from tidemark.operators import temporal

    one_each = spark.range(10)
    assert temporal._plan(one_each, "id") == ("broadcast", None)
    monkeypatch.setattr(temporal, "BROADCAST_VERSIONS", 9)
    assert temporal._plan(one_each, "id") == ("range", None)
    monkeypatch.setattr(temporal, "BROADCAST_VERSIONS", 100)
    monkeypatch.setattr(temporal, "BROADCAST_BYTES", 79)
    assert temporal._plan(one_each, "id") == ("range", None)
    monkeypatch.setattr(temporal, "BROADCAST_BYTES", 80)
    many = one_each.unionAll(spark.range(100).selectExpr("bigint(3) id"))
    method, long = temporal._plan(many, "id")
    assert method == "broadcast" and rows(long) == [(3, True)]
    assert temporal._plan(spark.range(0), "id") == ("broadcast", None)


def test_only_long_histories_are_joined_as_of(spark, monkeypatch):
    from tidemark.operators import temporal

    monkeypatch.setattr(temporal, "VERSIONS_PER_KEY", 3)
    hours = [f"2100-01-01 {h:02d}:00:00" for h in range(10)]
    versions = table(
        spark,
        VERSION,
        *[("long", f"R{h}", hours[h], hours[h + 1]) for h in range(9)],
        ("short", "EU", hours[2], OPEN),
        (None, "XX", hours[0], OPEN),
    )
    facts = table(
        spark,
        FACT,
        *[(h, "long", f"2100-01-01 {h:02d}:30:00") for h in range(10)],
        *[(20 + h, "short", hours[h]) for h in range(4)],
        (30, None, hours[1]),
        (31, "none", hours[1]),
    )
    expected = [(h, f"R{h}" if h < 9 else None) for h in range(10)]
    expected += [(20, None), (21, None), (22, "EU"), (23, "EU"), (30, None), (31, None)]
    for rows_per_group in (None, 2):
        assert rows(joined(facts, versions, "auto", rows_per_group), "event_id", "region") == sorted(expected, key=repr)


@pytest.mark.parametrize("method", ["range", "asof"])
def test_keys_of_different_types(spark, method):
    facts = table(
        spark,
        "user_id int, created_at timestamp_ntz",
        *[(1, f"2100-01-01 10:00:{i:02d}") for i in range(30)],
    )
    versions = table(
        spark,
        VERSION.replace("user_id string", "user_id bigint"),
        (1, "EU", "2100-01-01 00:00:00", OPEN),
    )
    for rows_per_group in (None, 3):
        result = joined(facts, versions, method, rows_per_group)
        assert rows(result.select("region").distinct()) == [("EU",)]
        assert result.count() == 30


def test_versions_are_repeated_for_the_hours_of_their_own_facts_only(spark):
    from tidemark.operators import temporal

    facts = table(
        spark,
        FACT,
        *[(i, "hot", "2100-01-01 00:00:00") for i in range(50)],
        *[(i, "wide", f"2100-01-{1 + i % 28:02d} 00:00:00") for i in range(60)],
    )
    versions = table(spark, VERSION, ("hot", "EU", "2099-01-01 00:00:00", OPEN))
    right = versions.select("user_id", F.col("dbt_valid_from").alias("_opens"), F.col("dbt_valid_to").alias("_ends"))
    left, copies, place = temporal._place(facts, right, "user_id", "created_at", 10)
    slots = left.where("user_id = 'hot'").select("_slot").distinct().count()
    # One hour, and tied facts on several slots.
    assert place == ["user_id", "_hour", "_slot"] and slots > 1
    assert copies.count() == copies.select("_slot").distinct().count() == 5
