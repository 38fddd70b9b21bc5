"""Analytics layer: current dimensions of live users and posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.attributes import or_zero
from tidemark.plans.metrics import creator_totals, post_totals, user_totals


def dim_posts(int_posts: DataFrame, agg_post: DataFrame) -> DataFrame:
    live = int_posts.where(F.col("deleted_at").isNull())
    return live.join(post_totals(agg_post), "post_id", "left").select(
        *[name for name in int_posts.columns if name != "deleted_at"],
        or_zero("likes"),
        or_zero("views"),
    )


def dim_users(int_users: DataFrame, agg_user: DataFrame, posts: DataFrame) -> DataFrame:
    """Live users with what they did and what the live posts they created got.

    Both totals are aggregated to one row per user before they are joined.
    """
    live = int_users.where(F.col("deleted_at").isNull())
    joined = live.join(user_totals(agg_user), "user_id", "left").join(
        creator_totals(posts), "user_id", "left"
    )
    return joined.select(
        *[name for name in int_users.columns if name != "deleted_at"],
        or_zero("likes_given"),
        or_zero("posts_viewed"),
        or_zero("total_likes"),
        or_zero("total_views"),
    )


def fct_events(int_events: DataFrame) -> DataFrame:
    """Event-grain facts, exposed as they are."""
    return int_events
