"""The given tables read as raw users, posts, events and change feeds.

``events`` carries the activity (a purchase counts as a like of the post in its
properties, every other kind is no like), ``customer`` the users, ``part`` the posts, ``nation`` and ``region``
the country lookup. Whatever the tables lack is derived from their columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import CHANGE_ID, CHANGE_TYPE, CHANGED_AT, SET_COLUMNS
from tidemark.schemas import timestamp

USERS_FROM = "2023-12-01 00:00:00"
POSTS_FROM = "2024-01-01 00:00:00"
SUPPLIER_USERS_FROM = 1_000_000_000
USER_ATTRIBUTES = ["first_name", "last_name", "country_code", "favorite_color"]


_KEY, _TEXT, _TIME = T.LongType(), T.StringType(), T.TimestampNTZType()
_INT, _NUMBER = T.IntegerType(), T.DoubleType()
# The columns read here; with them declared no file has to be opened for planning.
_COLUMNS = {
    "region": {"r_regionkey": _INT, "r_name": _TEXT},
    "nation": {"n_nationkey": _INT, "n_name": _TEXT, "n_regionkey": _INT},
    "customer": {
        "c_custkey": _KEY,
        "c_name": _TEXT,
        "c_nationkey": _INT,
        "c_acctbal": _NUMBER,
        "c_mktsegment": _TEXT,
    },
    "supplier": {"s_suppkey": _KEY, "s_name": _TEXT, "s_nationkey": _INT},
    "part": {"p_partkey": _KEY, "p_name": _TEXT, "p_size": _INT},
    "orders": {
        "o_orderkey": _KEY,
        "o_custkey": _KEY,
        "o_orderstatus": _TEXT,
        "o_orderdate": _TIME,
    },
    "events": {
        "event_id": _KEY,
        "ts": _TIME,
        "user_id": _KEY,
        "event_type": _TEXT,
        "value": _NUMBER,
        "props": _TEXT,
    },
}


def schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(*column) for column in _COLUMNS[name].items()])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(schema(name)).parquet(f"{folder}/{name}.parquet")


def _property() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _days(count: Column) -> Column:
    return F.make_dt_interval(days=count.cast("int"))


def _hours(count: Column) -> Column:
    return F.make_dt_interval(hours=count.cast("int"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return as_events(table(spark, folder, "events"))


def as_events(source: DataFrame) -> DataFrame:
    """Raw events from the rows of ``events``, read as a table or as a stream."""
    kind = F.when(F.col("event_type") == "purchase", "like").otherwise(F.col("event_type"))
    return source.select(
        "event_id",
        "user_id",
        _property().alias("post_id"),
        F.col("ts").alias("created_at"),
        kind.alias("event_type"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    created = timestamp(USERS_FROM) + _days(F.col("c_custkey") % 30)
    updated = created + _hours(F.col("c_custkey") % 24)
    name = F.split("c_name", "#")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        name[0].alias("first_name"),
        name[1].alias("last_name"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.when(F.col("c_acctbal") < 0, updated).alias("deleted_at"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("favorite_color"),
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts, dealt evenly to all users."""
    created = timestamp(POSTS_FROM) + _days(F.col("p_partkey") % 30) + _hours(F.col("p_size"))
    creators = max(1, table(spark, folder, "customer").count())
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("post_id"),
        (F.col("p_partkey") % creators).alias("user_id"),
        F.col("p_name").alias("post_text"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.when(F.col("p_size") > 45, created).alias("deleted_at"),
    )


def countries(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region")
    return (
        table(spark, folder, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").cast("string").alias("country_code"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("region"),
        )
    )


def user_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change feed of users: each signup event moves its user to a region."""
    regions = table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("_region"), F.col("r_name").alias("region")
    )
    moves = table(spark, folder, "events").where("event_type = 'signup'")
    return (
        moves.withColumn("_region", _property() % 5)
        .join(regions, "_region", "left")
        .select(
            "user_id",
            F.col("ts").alias("updated_at"),
            "region",
            F.col("event_id").alias("change_id"),
        )
    )


def user_presence(spark: SparkSession, folder: str) -> DataFrame:
    """Feed with deletions: a signup brings a user (back), an error removes it."""
    rows = table(spark, folder, "events").where(F.col("event_type").isin("signup", "error"))
    return rows.select(
        "user_id",
        F.col("ts").alias("updated_at"),
        _property().alias("score"),
        (F.col("event_type") == "signup").alias("present"),
        F.col("event_id").alias("change_id"),
    )


def user_change_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Changes to the users: signups update, finished last orders delete, suppliers join.

    A signup sets the country and, if its value is above 10, the colour as well.
    """
    nothing = F.lit(None).cast("string")
    no_time = F.lit(None).cast("timestamp_ntz")
    activity = table(spark, folder, "events").where("event_type = 'signup'")
    columns = F.when(F.col("value") > 10, F.array(F.lit("country_code"), F.lit("favorite_color")))
    updates = activity.select(
        "user_id",
        F.lit("update").alias(CHANGE_TYPE),
        F.col("ts").alias(CHANGED_AT),
        F.col("event_id").alias(CHANGE_ID),
        columns.otherwise(F.array(F.lit("country_code"))).alias(SET_COLUMNS),
        no_time.alias("created_at"),
        nothing.alias("first_name"),
        nothing.alias("last_name"),
        (_property() % 25).cast("string").alias("country_code"),
        F.when(_property() >= 10, F.concat(F.lit("COLOR_"), _property().cast("string"))).alias(
            "favorite_color"
        ),
    )
    last = F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey"))
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(
        last.alias("status"), F.max("o_orderdate").alias(CHANGED_AT)
    )
    deletes = orders.where("status = 'F'").select(
        F.col("o_custkey").alias("user_id"),
        F.lit("delete").alias(CHANGE_TYPE),
        CHANGED_AT,
    )
    starts = timestamp(POSTS_FROM) + _hours(F.col("s_suppkey") % 500)
    name = F.split("s_name", "#")
    inserts = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + SUPPLIER_USERS_FROM).alias("user_id"),
        F.lit("insert").alias(CHANGE_TYPE),
        starts.alias(CHANGED_AT),
        starts.alias("created_at"),
        name[0].alias("first_name"),
        name[1].alias("last_name"),
        F.col("s_nationkey").cast("string").alias("country_code"),
    )
    return updates.unionByName(deletes, allowMissingColumns=True).unionByName(
        inserts, allowMissingColumns=True
    )


def with_arrival(facts: DataFrame) -> DataFrame:
    """Adds the day an event is delivered: events of the posts from 70 on, a day late."""
    late = F.when(F.col("post_id") >= 70, 1).otherwise(0)
    return facts.withColumn("arrival_date", F.date_add(F.to_date("created_at"), late))
