"""Staging layer: raw tables with standard names and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.attributes import full_name, is_like


def stg_users(user: DataFrame) -> DataFrame:
    return user.select(
        "user_id",
        "first_name",
        "last_name",
        full_name("first_name", "last_name").alias("full_name"),
        "created_at",
        "updated_at",
        "deleted_at",
        "country_code",
        F.col("favorite_color").alias("fav_color"),
    )


def stg_posts(post: DataFrame) -> DataFrame:
    return post.select(
        "post_id", "user_id", "post_text", "created_at", "updated_at", "deleted_at"
    )


def stg_events(event: DataFrame) -> DataFrame:
    return event.select(
        "event_id",
        "user_id",
        "post_id",
        "created_at",
        "event_type",
        is_like().alias("is_like"),
        F.to_date("created_at").alias("partition_date"),
    )
