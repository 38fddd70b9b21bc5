"""The plans that matter at scale: what is scanned, shuffled and broadcast."""

import re

import pytest
from helpers import day, table
from pyspark.sql import functions as F

from tidemark.operators import incremental as inc
from tidemark.operators.incremental import IncrementalTable
from tidemark.operators.snapshots import first_snapshot, snapshot_run
from tidemark.operators import temporal
from tidemark.operators.temporal import temporal_join
from tidemark.plans import analyses, metrics, staging
from tidemark.sources import adapter
from tidemark.sources.tables import bucket_count, write_bucketed

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out.split("== Physical Plan ==")[1]

    return text


def tree(text):
    return text.split("\n\n\n")[0]


def count(text, node):
    return len(re.findall(rf"[- ]{node} \(\d+\)", tree(text)))


@pytest.fixture
def facts(spark, tmp_path):
    """Facts and versions as the warehouse stores them."""
    events = staging.stg_events(adapter.events(spark, FOLDER))
    stored = IncrementalTable(f"{tmp_path}/facts", ("event_id",), "partition_date")
    inc.full_refresh(events, stored)
    return stored.read(spark)


@pytest.fixture
def versions(spark, tmp_path):
    users = adapter.users(spark, FOLDER).select("user_id", "country_code", "updated_at")
    first_snapshot(users.withColumnRenamed("country_code", "region"), "user_id", "updated_at").write.parquet(
        f"{tmp_path}/versions"
    )
    return spark.read.parquet(f"{tmp_path}/versions")


def test_monthly_users_shuffle_each_side_once(facts, versions, no_broadcast, plan):
    text = plan(analyses.mau_by_region_and_month(facts, versions, 2024, method="range"))
    # Both join sides, the groups and the final sort.
    assert count(text, "Exchange") == 4
    assert count(text, "SortMergeJoin LeftOuter") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    scan = text.split("Scan parquet")[-2] + text.split("Scan parquet")[-1]
    assert "PartitionFilters: [isnotnull(partition_date" in text
    assert "ReadSchema: struct<user_id:bigint,created_at:timestamp_ntz>" in scan


def test_as_of_plan_shuffles_once(facts, versions, no_broadcast, plan):
    text = plan(analyses.mau_by_region_and_month(facts, versions, 2024, method="asof"))
    assert count(text, "Exchange") == 3
    assert "Join" not in tree(text)


def test_few_versions_are_broadcast_and_facts_stay(facts, versions, no_broadcast, plan):
    text = plan(temporal_join(facts, versions, "user_id", "created_at", ["region"]))
    assert "BroadcastHashJoin LeftOuter" in text and count(text, "Exchange") == 0


def test_hot_keys_are_joined_by_hour(facts, versions, no_broadcast, plan):
    text = plan(
        temporal_join(facts, versions, "user_id", "created_at", ["region"], "range", rows_per_group=10)
    )
    assert re.search(r"hashpartitioning\(user_id#\d+L, _hour#\d+", text)


def test_user_metrics_do_not_expand(facts, plan):
    assert "Expand" not in plan(metrics.agg_user_metrics_daily(facts))
    assert "Expand" in plan(metrics.agg_user_metrics_daily_distinct(facts))


def test_bucketed_facts_and_versions_meet_without_a_shuffle(spark, facts, versions, tmp_path, no_broadcast, plan):
    left = write_bucketed(facts, f"{tmp_path}/bucketed_facts", "user_id", 8)
    right = write_bucketed(versions, f"{tmp_path}/bucketed_versions", "user_id", 8)
    joined = temporal_join(left, right, "user_id", "created_at", ["region"], "range")
    text = plan(joined)
    assert "SortMergeJoin LeftOuter" in text and count(text, "Exchange") == 0
    assert "SelectedBucketsCount: 8 out of 8" in text
    asof = temporal_join(facts, versions, "user_id", "created_at", ["region"], "asof")
    columns = ["event_id", "region"]
    assert sorted(joined.select(columns).collect(), key=repr) == sorted(asof.select(columns).collect(), key=repr)
    assert [bucket_count(n) for n in (0, 1, 10**8, 10**9)] == [8, 8, 32, 256]


def test_too_many_versions_are_not_broadcast(facts, versions, no_broadcast, plan, monkeypatch):
    def join():
        return tree(plan(temporal_join(facts, versions, "user_id", "created_at", ["region"], "broadcast")))

    assert "BroadcastHashJoin" in join()
    monkeypatch.setattr(temporal, "BROADCAST_VERSIONS", 3)
    assert "BroadcastHashJoin" not in join()


def test_raw_events_are_pruned_in_the_scan(spark, plan):
    events = staging.stg_events(adapter.events(spark, FOLDER))
    text = plan(events.select("user_id", "is_like").where("user_id > 3"))
    assert "PushedFilters: [IsNotNull(user_id), GreaterThan(user_id,3)]" in text
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text


def test_recent_days_read_their_partitions_only(spark, facts, plan):
    text = plan(inc.since_day(facts, "partition_date", day("2024-01-20")))
    assert re.search(r"PartitionFilters: \[.*>= 2024-01-20", text)


def test_batch_keys_find_their_days_without_shuffling_the_table(spark, facts, tmp_path, plan):
    stored = IncrementalTable(f"{tmp_path}/facts", ("event_id",), "partition_date")
    batch = facts.where(F.col("partition_date") == F.lit(day("2024-01-20")))
    with inc.merged_days(batch, stored) as update:
        text = plan(update.content)
    assert "BroadcastHashJoin LeftAnti" in text and count(text, "Exchange") == 0
    assert update.days == {day("2024-01-20")}


def test_closed_versions_pass_a_snapshot_without_a_shuffle(spark, versions, no_broadcast, plan):
    source = versions.select("user_id", "region", "updated_at")
    text = plan(snapshot_run(versions, source, "user_id", "updated_at"))
    assert count(text, "Exchange") == 2 and "Union" in tree(text)


def test_sessions_shuffle_combined_slots(facts, plan):
    from tidemark.operators.sessions import viewer_sessions

    text = tree(plan(viewer_sessions(facts)))
    below_first_shuffle = text[text.rindex("Exchange") :]
    assert "HashAggregate" in below_first_shuffle
    assert len(re.findall("Exchange", text)) == 2


def test_samples_are_a_top_n(spark, plan):
    from tidemark.operators.sampling import random_live_rows

    users = table(spark, "user_id int, deleted_at timestamp_ntz", (1, None), (2, None))
    assert "TakeOrderedAndProject" in plan(random_live_rows(users, "user_id", 1, seed=1))
