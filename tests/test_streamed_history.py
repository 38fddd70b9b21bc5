"""A history from microbatches against one from all changes at once."""

import random

import pytest
from helpers import rows, table
from pyspark.sql import functions as F

from tidemark.operators.intervals import history_from_runs
from tidemark.sources.keyed import KeyedTable
from tidemark.streaming import history as streamed
from tidemark.streaming.events import read_stream, run_available

FEED = "k string, updated_at timestamp_ntz, name string, id int"
SHOW = ("k", "name", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id")


def feeds(spark, batches=4, seed=2):
    """Changes of each batch; later batches have later changes."""
    rng = random.Random(seed)
    found = []
    for number in range(batches):
        given = [
            (f"k{rng.randrange(9)}", f"2100-01-{1 + number:02d} {rng.randrange(24):02d}:00:00", f"n{number}-{i}", i)
            for i in range(20)
        ]
        found.append(table(spark, FEED, *given))
    return found


@pytest.fixture
def history(tmp_path):
    return streamed.StreamedHistory(f"{tmp_path}/h", "k", "updated_at", "id")


def expected(batches):
    runs = [batch.withColumn("run", F.lit(n)) for n, batch in enumerate(batches)]
    feed = runs[0]
    for more in runs[1:]:
        feed = feed.unionByName(more)
    found = history_from_runs(feed, "k", "updated_at", F.col("run"), "id")
    return rows(found, *SHOW)


def test_batches_equal_runs_and_come_again(spark, history):
    batches = feeds(spark)
    assert history.read(spark) is None
    for number, batch in enumerate(batches):
        for _ in range(2):
            history.apply(batch, number)
        assert rows(history.read(spark), *SHOW) == expected(batches[: number + 1])


def test_a_batch_that_broke_off_is_done_again(spark, history, monkeypatch):
    batches = feeds(spark)
    history.apply(batches[0], 0)
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "apply", lambda *_: (_ for _ in ()).throw(RuntimeError("lost the driver")))
        with pytest.raises(RuntimeError):
            history.apply(batches[1], 1)
    # Its closed versions are there already and do not count.
    assert rows(history.read(spark), *SHOW) == expected(batches[:1])
    history.apply(batches[1], 1)
    assert rows(history.read(spark), *SHOW) == expected(batches[:2])


def test_a_batch_writes_versions_of_its_keys_only(spark, history):
    many = spark.range(500).selectExpr(
        "concat('k', id) as k", "timestamp_ntz'2100-01-01 00:00:00' as updated_at", "'x' as name", "cast(id as int) id"
    )
    history.apply(many, 0)
    history.apply(table(spark, FEED, ("k3", "2100-01-02 00:00:00", "y", 1), ("new", "2100-01-02 00:00:00", "z", 2)), 1)
    assert rows(spark.read.parquet(f"{history.path}/open/changes-1"), "k", "name") == [("k3", "y"), ("new", "z")]
    assert rows(spark.read.parquet(f"{history.path}/closed/batch-1"), "k", "name") == [("k3", "x")]
    assert history.read(spark).count() == 502


def test_from_a_stream(spark, tmp_path, history):
    batches = feeds(spark, 3)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{tmp_path}/source")
        stream = read_stream(spark, f"{tmp_path}/source", batch.schema)
        run_available(streamed.keep_streamed_history(stream, history), f"{tmp_path}/progress")
    assert rows(history.read(spark), *SHOW) == expected(batches)
