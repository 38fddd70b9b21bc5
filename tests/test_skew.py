from helpers import rows

from pyspark.sql import functions as F

from tidemark.operators import skew


def test_heavy_groups_and_their_splits(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("k"))
    heavy = skew.heavy_groups(df, ["k"], rows_per_group=100)
    assert rows(heavy.groups, "_splits") == [(7,)]
    marked = heavy.mark(df.distinct(), "splits")
    assert rows(marked.where("splits is not null")) == [(0, 7)]
    assert not skew.heavy_groups(df, ["k"], rows_per_group=700)
    assert not skew.heavy_groups(df.limit(0), ["k"])


def test_large_groups_are_recognised_by_a_fraction(spark):
    rows_per_group = 10 * skew.RECOGNISED_BY
    df = spark.range(3 * rows_per_group).select((F.col("id") % 4 == 0).alias("k"))
    heavy = skew.heavy_groups(df, ["k"], rows_per_group)
    assert rows(heavy.groups, "_splits") == [(3,)]


def test_rows_of_a_hot_key_are_spread_and_joined_once(spark):
    left = spark.range(500).select("id", F.when(F.col("id") % 5 > 0, 1).otherwise(F.col("id")).alias("k"))
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("double"))
    spread = skew.spread_left_join(left, right, "k", ["id"], rows_per_group=20)
    assert rows(spread, "id", "k", "double") == rows(left.join(right, "k", "left"), "id", "k", "double")
    heavy = skew.heavy_groups(left, ["k"], 20)
    slots = heavy.mark(left, "n").withColumn("slot", skew.slot_of("n", ["id"])).where("k = 1")
    assert slots.groupBy("slot").count().agg(F.max("count")).first()[0] < 60


def test_keys_of_different_types_meet(spark):
    left = spark.range(100).select("id", F.lit(7).cast("int").alias("k"))
    right = spark.range(10**10, 10**10 + 2).unionAll(spark.range(9)).select(F.col("id").alias("k"), "id")
    right = right.withColumnRenamed("id", "found")
    spread = skew.spread_left_join(left, right, "k", ["id"], rows_per_group=10)
    assert rows(spread.select("found").distinct()) == [(7,)] and spread.count() == 100
    wide = left.withColumn("k", F.col("k").cast("bigint"))
    narrow = spark.range(9).select(F.col("id").cast("int").alias("k"), F.col("id").alias("found"))
    spread = skew.spread_left_join(wide, narrow, "k", ["id"], rows_per_group=10)
    assert rows(spread.select("found").distinct()) == [(7,)] and spread.count() == 100


def test_more_groups_than_go_to_every_task(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_GROUPS", 3)
    left = spark.range(500).select("id", (F.col("id") % 10).alias("k"))
    right = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("double"))
    heavy = skew.heavy_groups(left, ["k"], 20)
    assert heavy and not heavy.few and heavy.groups.count() == 10
    spread = skew.spread_left_join(left, right, "k", ["id"], rows_per_group=20)
    assert rows(spread, "id", "k", "double") == rows(left.join(right, "k"), "id", "k", "double")


def test_groups_are_not_counted_in_one_task(spark, monkeypatch):
    plans = []
    frame = type(spark.range(0))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: (plans.append(df._jdf.queryExecution().toString()), collect(df))[1])
    skew.heavy_groups(spark.range(1000, numPartitions=4), ["id"], 10)
    before_limit = plans[0].split("LocalLimit")[-1]
    assert "hashpartitioning(" in before_limit and "approx_top_k" not in plans[0]
