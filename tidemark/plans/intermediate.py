"""Intermediate layer: users and posts as business entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.attributes import or_unknown
from tidemark.operators.skew import ROWS_PER_GROUP, spread_left_join


def int_users(stg_users: DataFrame, countries: DataFrame) -> DataFrame:
    """Users with country and region; missing cohort attributes become Unknown.

    The country lookup is broadcast when its size allows, which Spark checks.
    """
    names = countries.select("country_code", F.col("name").alias("country"), "region")
    return stg_users.join(names, "country_code", "left").select(
        "user_id",
        "first_name",
        "last_name",
        "full_name",
        or_unknown("country_code"),
        or_unknown("country"),
        or_unknown("region"),
        or_unknown("fav_color"),
        "created_at",
        "updated_at",
        "deleted_at",
    )


def int_posts(
    stg_posts: DataFrame, users: DataFrame, rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """Posts with their creator's attributes, NULL where the creator is absent."""
    creators = users.select(
        F.col("user_id").alias("creator_id"),
        F.col("country_code").alias("creator_country_code"),
        F.col("country").alias("creator_country"),
        F.col("region").alias("creator_region"),
        F.col("fav_color").alias("creator_fav_color"),
    )
    posts = stg_posts.withColumnRenamed("user_id", "creator_id")
    return spread_left_join(posts, creators, "creator_id", ["post_id"], rows_per_group).select(
        "post_id",
        "post_text",
        "creator_country_code",
        "creator_country",
        "creator_region",
        "creator_fav_color",
        "created_at",
        "updated_at",
        "deleted_at",
        "creator_id",
    )


def with_post_length(posts: DataFrame) -> DataFrame:
    return posts.withColumn("post_length", F.length("post_text"))


def int_events(stg_events: DataFrame) -> DataFrame:
    """Passes the events through; Spark inlines it."""
    return stg_events
