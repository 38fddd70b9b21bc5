"""Daily engagement metrics and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.attributes import ratio
from tidemark.functions.calendar import next_day_start
from tidemark.operators.intervals import first_per_group


def agg_post_metrics_daily(events: DataFrame) -> DataFrame:
    """``(event_date, post_id)``: likes are all likes, views are distinct viewers."""
    viewer = F.when(F.col("is_like") == 0, F.col("user_id"))
    return events.groupBy(F.col("partition_date").alias("event_date"), "post_id").agg(
        F.sum("is_like").alias("likes"), F.count_distinct(viewer).alias("views")
    )


def agg_user_metrics_daily(events: DataFrame) -> DataFrame:
    """``(event_date, user_id)``: distinct posts liked and distinct posts viewed.

    Two distinct counts over different rows would make Spark double every row.
    Reducing to one row per user and post first needs no such expansion, and a
    very active user is spread over tasks by post.
    """
    counted = F.col("post_id").isNotNull()
    day = F.col("partition_date").alias("event_date")
    per_post = events.groupBy(day, "user_id", "post_id").agg(
        F.max(F.when(counted & (F.col("is_like") == 1), 1).otherwise(0)).alias("liked"),
        F.max(F.when(counted & (F.col("is_like") == 0), 1).otherwise(0)).alias("viewed"),
    )
    return per_post.groupBy("event_date", "user_id").agg(
        F.sum("liked").alias("likes_given"), F.sum("viewed").alias("posts_viewed")
    )


def agg_user_metrics_daily_distinct(events: DataFrame) -> DataFrame:
    """The same table written with two distinct counts; kept to compare the plans."""
    return events.groupBy(F.col("partition_date").alias("event_date"), "user_id").agg(
        F.count_distinct(F.when(F.col("is_like") == 1, F.col("post_id"))).alias("likes_given"),
        F.count_distinct(F.when(F.col("is_like") == 0, F.col("post_id"))).alias("posts_viewed"),
    )


def post_totals(agg_post: DataFrame) -> DataFrame:
    return agg_post.groupBy("post_id").agg(
        F.sum("likes").alias("likes"), F.sum("views").alias("views")
    )


def user_totals(agg_user: DataFrame) -> DataFrame:
    return agg_user.groupBy("user_id").agg(
        F.sum("likes_given").alias("likes_given"), F.sum("posts_viewed").alias("posts_viewed")
    )


def creator_totals(dim_posts: DataFrame) -> DataFrame:
    return dim_posts.groupBy(F.col("creator_id").alias("user_id")).agg(
        F.sum("likes").alias("total_likes"), F.sum("views").alias("total_views")
    )


def with_like_ratio(df: DataFrame, likes: str = "likes", views: str = "views") -> DataFrame:
    """Likes per view, NULL without views; for posts and for creators."""
    return df.withColumn("like_ratio", ratio(likes, views))


def activity(daily: DataFrame, key: str, active_days: int, as_of: Column) -> DataFrame:
    """``(key, last_active, is_active)`` as of a day.

    Active means seen on one of the last ``active_days`` days, that day included.
    """
    last = daily.groupBy(key).agg(F.max("event_date").alias("last_active"))
    return last.withColumn("is_active", F.col("last_active") > F.date_sub(as_of, active_days))


def creator_daily(agg_post: DataFrame, posts: DataFrame) -> DataFrame:
    """Daily likes and views of a creator's posts."""
    owners = posts.select("post_id", "creator_id")
    return (
        agg_post.join(owners, "post_id")
        .groupBy("event_date", "creator_id")
        .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
    )


def without_repeated_likes(events: DataFrame) -> DataFrame:
    """Keeps a user's first like of a post and drops later ones; views stay.

    Likes without a user or a post repeat nothing that is known, and stay as well.
    """
    known = F.col("user_id").isNotNull() & F.col("post_id").isNotNull()
    is_like = F.coalesce(F.col("is_like") == 1, F.lit(False)) & known
    first = first_per_group(
        events.where(is_like), ["user_id", "post_id"], ["created_at", "event_id"]
    )
    return events.where(~is_like).unionByName(first)


def with_day_end(daily: DataFrame, name: str) -> DataFrame:
    """The last instant of each daily row, to look up versions at day grain."""
    end = next_day_start(F.col("event_date")) - F.expr("interval 1 microsecond")
    return daily.withColumn(name, end)
