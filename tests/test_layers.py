import datetime as dt

import pytest
from helpers import at, day, rows, table
from pyspark.sql import functions as F

from tidemark.plans import dimensions, intermediate, metrics, staging
from tidemark.sources import tables

USER = (
    "user_id string, first_name string, last_name string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, deleted_at timestamp_ntz, country_code string, favorite_color string"
)
POST = (
    "post_id string, user_id string, post_text string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, deleted_at timestamp_ntz"
)
EVENT = "event_id string, user_id string, post_id string, created_at timestamp_ntz, event_type string"
T0, T1 = "2100-01-01 10:00:00", "2100-01-02 10:00:00"

SEED = """country_code,name,currency,region,subregion
NA,Namibia,NAD,Africa,Southern Africa
BV,Bouvet Island,NOK,,
GM,"The Gambia ",GMD,Africa,Western Africa
CW,"Curaçao, an island",ANG,Americas,Caribbean
"""


@pytest.fixture
def countries(spark, tmp_path):
    path = tmp_path / "countries.csv"
    path.write_text(SEED, encoding="utf-8")
    return tables.read_countries(spark, str(path))


def user(name, country="NA", colour="red", last="B", deleted=None):
    return (name, "A", last, T0, T0, deleted, country, colour)


def users_of(spark, countries, *rows_):
    return intermediate.int_users(staging.stg_users(table(spark, USER, *rows_)), countries)


def events_of(spark, *rows_):
    return staging.stg_events(table(spark, EVENT, *rows_))


def test_seed_keeps_na_and_spaces_and_reads_blank_as_null(countries):
    found = {r["country_code"]: (r["name"], r["region"]) for r in countries.collect()}
    assert found == {
        "NA": ("Namibia", "Africa"),
        "BV": ("Bouvet Island", None),
        "GM": ("The Gambia ", "Africa"),
        "CW": ("Curaçao, an island", "Americas"),
    }


def test_unknown_only_where_a_value_is_missing(spark, countries):
    users = users_of(
        spark,
        countries,
        user("none", None, None),
        user("unlisted", "ZZ"),
        user("blank", "BV"),
        user("namibia", "NA"),
    )
    assert rows(users, "user_id", "country_code", "country", "region", "fav_color") == [
        ("blank", "BV", "Bouvet Island", "Unknown", "red"),
        ("namibia", "NA", "Namibia", "Africa", "red"),
        ("none", "Unknown", "Unknown", "Unknown", "Unknown"),
        ("unlisted", "ZZ", "Unknown", "Unknown", "red"),
    ]


def test_full_name_is_null_without_last_name(spark, countries):
    users = users_of(spark, countries, user("a"), user("b", last=None))
    assert rows(users, "user_id", "full_name") == [("a", "A B"), ("b", None)]


def test_post_without_creator_row_has_null_attributes(spark, countries):
    users = users_of(spark, countries, user("u", None))
    posts = intermediate.int_posts(
        staging.stg_posts(
            table(spark, POST, ("p", "u", "x", T0, T0, None), ("q", "gone", "x", T0, T0, None))
        ),
        users,
    )
    assert rows(posts, "post_id", "creator_id", "creator_region") == [
        ("p", "u", "Unknown"),
        ("q", "gone", None),
    ]


def test_hot_creator_and_missing_creators_are_spread(spark, countries):
    users = users_of(spark, countries, user("hot"), user("cold"))
    many = [(f"p{i}", "hot" if i % 3 else None, "x", T0, T0, None) for i in range(60)]
    posts = staging.stg_posts(table(spark, POST, *many, ("c", "cold", "x", T0, T0, None)))
    spread = intermediate.int_posts(posts, users, rows_per_group=5)
    assert rows(spread) == rows(intermediate.int_posts(posts, users))
    assert spread.count() == 61


def test_is_like_is_zero_for_a_missing_type(spark):
    events = events_of(spark, ("a", "u", "p", T0, None), ("b", "u", "p", T0, "like"))
    assert rows(events, "event_id", "is_like", "partition_date") == [
        ("a", 0, day("2100-01-01")),
        ("b", 1, day("2100-01-01")),
    ]


def test_double_like_counts_twice_for_the_post_and_once_for_the_user(spark):
    events = events_of(
        spark,
        ("a", "u", "p", T0, "like"),
        ("b", "u", "p", "2100-01-01 11:00:00", "like"),
    )
    assert rows(metrics.agg_post_metrics_daily(events)) == [(day("2100-01-01"), "p", 2, 0)]
    assert rows(metrics.agg_user_metrics_daily(events)) == [(day("2100-01-01"), "u", 1, 0)]


def test_views_add_up_over_days(spark):
    events = events_of(spark, ("a", "u", "p", T0, "view"), ("b", "u", "p", T1, "view"))
    totals = metrics.post_totals(metrics.agg_post_metrics_daily(events))
    assert rows(totals) == [("p", 0, 2)]


def test_both_forms_of_the_user_metrics_agree(spark):
    events = events_of(
        spark,
        *[(f"{u}{p}{k}{n}", u, p, T0, k) for u in "ab" for p in "pqr" for k in ("view", "like") for n in "12"],
        ("like only", "c", "p", T0, "like"),
        ("no post", "d", None, T0, "view"),
        ("no type", "e", "p", T0, None),
    )
    ours = rows(metrics.agg_user_metrics_daily(events))
    assert ours == rows(metrics.agg_user_metrics_daily_distinct(events))
    assert (day("2100-01-01"), "c", 1, 0) in ours
    assert (day("2100-01-01"), "d", 0, 0) in ours


def test_dimensions_drop_deleted_rows_but_facts_keep_counting(spark, countries):
    users = users_of(spark, countries, user("maker"), user("gone", deleted=T1), user("idle"))
    posts = intermediate.int_posts(
        staging.stg_posts(
            table(
                spark,
                POST,
                ("live", "maker", "x", T0, T0, None),
                ("dead", "maker", "x", T0, T1, T1),
                ("of gone", "gone", "x", T0, T0, None),
            )
        ),
        users,
    )
    events = events_of(
        spark,
        ("1", "gone", "live", T0, "view"),
        ("2", "maker", "dead", T0, "like"),
        ("3", "idle", "of gone", T0, "like"),
    )
    agg_post = metrics.agg_post_metrics_daily(events)
    dim_posts = dimensions.dim_posts(posts, agg_post)
    assert "deleted_at" not in dim_posts.columns
    assert rows(dim_posts, "post_id", "creator_region", "likes", "views") == [
        ("live", "Africa", 0, 1),
        ("of gone", "Africa", 1, 0),
    ]
    dim_users = dimensions.dim_users(users, metrics.agg_user_metrics_daily(events), dim_posts)
    metric = ("likes_given", "posts_viewed", "total_likes", "total_views")
    assert rows(dim_users, "user_id", *metric) == [
        ("idle", 1, 0, 0, 0),
        ("maker", 1, 0, 0, 1),
    ]


def test_ratio_is_null_without_views(spark):
    df = table(spark, "likes bigint, views bigint", (1, 0), (1, 4))
    assert rows(metrics.with_like_ratio(df)) == [(1, 0, None), (1, 4, 0.25)]


def test_activity_counts_back_from_the_newest_day(spark):
    daily = table(
        spark, "event_date date, user_id string", ("2100-01-05", "a"), ("2100-01-03", "b"), ("2100-01-02", "c")
    )
    as_of = daily.agg(F.max("event_date")).scalar()
    assert rows(metrics.activity(daily, "user_id", 3, as_of), "user_id", "is_active") == [
        ("a", True),
        ("b", True),
        ("c", False),
    ]


def test_first_like_is_kept(spark):
    events = events_of(
        spark,
        ("2", "u", "p", T1, "like"),
        ("1", "u", "p", T0, "like"),
        ("3", "u", "p", T1, "view"),
        ("4", "u", "p", T1, "view"),
        ("5", "v", "p", T1, "like"),
    )
    assert rows(metrics.without_repeated_likes(events), "event_id") == [
        ("1",),
        ("3",),
        ("4",),
        ("5",),
    ]


def test_raw_tables_are_read_with_their_schema(spark, tmp_path):
    table(spark, EVENT, ("a", "u", "p", T0, "view")).write.parquet(f"{tmp_path}/event")
    raw = tables.read_raw(spark, str(tmp_path), "event")
    assert rows(raw) == [("a", "u", "p", at(T0), "view")]


def test_table_can_be_rewritten_from_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert tables.read_table(spark, path) is None
    tables.write_table(spark.range(10), path)
    tables.write_table(tables.read_table(spark, path).where("id < 3"), path)
    assert tables.read_table(spark, path).count() == 3
    # A version that was not completed is not seen.
    spark.range(5).write.parquet(f"{path}/v=2")
    (tmp_path / "t" / "v=2" / "_SUCCESS").unlink()
    assert tables.read_table(spark, path).count() == 3
    tables.drop_old_versions(spark, path, keep=1)
    assert sorted(f.name for f in (tmp_path / "t").iterdir()) == ["v=1", "v=2"]
    assert tables.read_table(spark, path).count() == 3


def test_append(spark, tmp_path):
    for _ in range(2):
        tables.append(spark.range(3), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 6


def test_view(spark):
    tables.publish_view(spark.range(2), "two_rows")
    assert spark.sql("select count(*) n from two_rows").first()["n"] == 2


def test_post_length(spark):
    posts = spark.createDataFrame([("abc",), (None,)], "post_text string")
    assert rows(intermediate.with_post_length(posts)) == [("abc", 3), (None, None)]


def test_dates(spark):
    from tidemark.operators.spine import date_spine, spine_of

    spine = date_spine(spark, dt.date(2100, 1, 1), dt.date(2101, 1, 1))
    assert spine.count() == 365
    sunday = spine.where(F.col("date_day") == F.lit(dt.date(2100, 1, 3))).first()
    assert sunday["iso_day_of_week"] == 7 and sunday["is_weekend"]
    assert sunday["month_name"] == "January" and sunday["day_of_year"] == 3
    assert sunday["date_quarter"] == day("2100-01-01")
    assert len(spine.columns) == 12
    days = table(spark, "d date", ("2100-02-27",), ("2100-03-02",))
    assert [r[0] for r in spine_of(days, "d").select("date_day").orderBy("date_day").collect()] == [
        day("2100-02-27"),
        day("2100-02-28"),
        day("2100-03-01"),
        day("2100-03-02"),
    ]
    assert spine_of(days.where("false"), "d").count() == 0


def test_bounds_of_a_day_and_a_year(spark):
    from tidemark.functions.calendar import day_start, hour_number, in_year, next_day_start

    days = table(spark, "d date", ("2099-12-31",), ("2100-01-01",), ("2100-12-31",))
    bounds = days.select(day_start(F.col("d")), next_day_start(F.col("d")))
    assert rows(bounds)[0] == (at("2099-12-31 00:00:00"), at("2100-01-01 00:00:00"))
    assert days.where(in_year("d", 2100)).count() == 2
    times = table(spark, "t timestamp_ntz", ("1970-01-02 03:59:59",), ("1969-12-31 23:00:00",))
    assert rows(times.select(hour_number(F.col("t")))) == [(-1,), (27,)]


def test_gaps_are_filled_between_first_and_last_day(spark):
    from tidemark.operators.spine import fill_daily_gaps

    daily = table(
        spark,
        "event_date date, user_id string, n int",
        ("2100-01-01", "a", 5),
        ("2100-01-04", "a", 7),
        ("2100-01-02", "b", 1),
    )
    assert rows(fill_daily_gaps(daily, "user_id", "event_date", ["n"])) == [
        (day("2100-01-01"), "a", 5),
        (day("2100-01-02"), "a", 0),
        (day("2100-01-02"), "b", 1),
        (day("2100-01-03"), "a", 0),
        (day("2100-01-04"), "a", 7),
    ]
