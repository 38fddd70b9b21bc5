"""Raw rows as a base and the changes since."""

import datetime as dt
import random

import pytest
from helpers import rows, table
from pyspark.sql import functions as F

from tidemark.operators import changes as ch
from tidemark.plans.build import Warehouse, ingest_day, raw_state
from tidemark.sources import paths
from tidemark.sources.keyed import APPLIED_ON, KeyedTable

FIRST = dt.date(2100, 1, 1)


def day(number):
    return FIRST + dt.timedelta(days=number)


def values(spark, given):
    return table(spark, "id string, value string", *given)


@pytest.fixture
def keyed(tmp_path):
    return KeyedTable(f"{tmp_path}/t", "id")


def put(spark, keyed, number, *given):
    return keyed.apply(spark, day(number), lambda _: values(spark, given))


def state(spark, keyed):
    return rows(keyed.read(spark), "id", "value")


def test_newest_row_of_each_key(spark, keyed):
    assert keyed.read(spark) is None and keyed.of_day(spark, FIRST) is None
    put(spark, keyed, 0, ("a", "0"), ("b", "0"), ("c", "0"), (None, "0"))
    put(spark, keyed, 1, ("a", "1"), ("d", "1"), (None, "1"))
    put(spark, keyed, 2, ("a", "2"), ("b", None))
    expected = [("a", "2"), ("b", None), ("c", "0"), ("d", "1"), (None, "0"), (None, "1")]
    assert state(spark, keyed) == sorted(expected, key=repr)
    assert rows(keyed.of_day(spark, day(1)), "id") == sorted([("a",), ("d",), (None,)], key=repr)


def test_a_day_is_applied_once(spark, keyed):
    put(spark, keyed, 0, ("a", "0"))
    put(spark, keyed, 1, ("a", "1"))
    assert rows(put(spark, keyed, 1, ("a", "other")), "value") == [("1",)]
    assert rows(put(spark, keyed, 0, ("a", "other")), "value") == [("0",)]
    assert state(spark, keyed) == [("a", "1")]


def test_a_day_that_broke_off_does_not_count(spark, keyed):
    put(spark, keyed, 0, ("a", "0"))
    folder = f"{keyed.path}/changes-{day(1).isoformat()}"
    values(spark, [("a", "broken")]).write.parquet(folder)
    paths.remove(spark, f"{folder}/_SUCCESS")
    assert state(spark, keyed) == [("a", "0")]
    put(spark, keyed, 1, ("a", "1"))
    assert state(spark, keyed) == [("a", "1")]


@pytest.mark.parametrize("share, days", [(0.0, 32), (10.0, 3), (10.0, 1000)])
def test_folded_or_not_the_rows_are_the_same(spark, tmp_path, share, days):
    keyed = KeyedTable(f"{tmp_path}/t", "id", fold_share=share, fold_days=days)
    rng, expected = random.Random(7), {}
    for number in range(9):
        changed = {str(rng.randrange(40)): f"{number}" for _ in range(40 if not number else 6)}
        expected |= changed
        put(spark, keyed, number, *changed.items())
        assert state(spark, keyed) == sorted(expected.items())
    names = paths.names(spark, keyed.path)
    bases = [n for n in names if n.startswith("base-")]
    assert len(bases) == (1 if days == 1000 else 2)
    if share == 0.0:
        # Old copies are gone.
        assert len(names) <= 5
    assert rows(keyed.of_day(spark, day(8)), "value") == [("8",)] * len(changed)


def test_a_fold_that_broke_off_changes_nothing(spark, tmp_path, monkeypatch):
    keyed = KeyedTable(f"{tmp_path}/t", "id", fold_share=0.0)
    put(spark, keyed, 0, ("a", "0"), ("b", "0"))
    put(spark, keyed, 1, ("a", "1"))
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "read", lambda *_: values(spark, [("x", "x")]).select(F.raise_error(F.lit("lost"))))
        with pytest.raises(Exception, match="lost"):
            put(spark, keyed, 2, ("b", "2"))
    assert state(spark, keyed) == [("a", "1"), ("b", "0")]
    put(spark, keyed, 2, ("b", "2"))
    assert state(spark, keyed) == [("a", "1"), ("b", "2")]


def changes_of(spark, kind, ids, at):
    return spark.createDataFrame([(i,) for i in ids], "user_id long").selectExpr(
        "user_id", f"'{kind}' as change_type", f"timestamp_ntz'{at}' as changed_at",
        f"timestamp_ntz'{at}' as created_at", "array('country_code') as set_columns",
        "uuid() as first_name", "uuid() as last_name", "'FR' as country_code", "'red' as favorite_color",
    )


def test_a_day_writes_what_it_changes(spark, tmp_path):
    """One in a hundred rows changes a day: about that much is written, and copies stay bounded."""
    warehouse = Warehouse(str(tmp_path))
    nothing = table(spark, "event_id string, user_id string, post_id string, created_at timestamp_ntz, event_type string")
    folder = warehouse.raw("user").path
    now = dt.datetime(2100, 1, 1)
    ingest_day(spark, warehouse, {"user": changes_of(spark, "insert", range(10_000), "2100-01-01 00:00:00")}, nothing, FIRST, now)
    before = paths.size(spark, folder)
    for number in range(1, 4):
        ids = range(number * 100, number * 100 + 100)
        batch = changes_of(spark, "update", ids, f"2100-01-0{number + 1} 00:00:00")
        ingest_day(spark, warehouse, {"user": batch}, nothing, day(number), now)
        written = paths.size(spark, f"{folder}/changes-{day(number).isoformat()}")
        assert written < 0.03 * before
    found = raw_state(spark, warehouse, "user")
    assert found.count() == 10_000 and found.where("country_code = 'FR'").count() == 10_000
    assert found.where("updated_at > timestamp_ntz'2100-01-01 00:00:00'").count() == 300
    audit = spark.read.parquet(warehouse.path("raw", "ingestion_audit")).where("table_name = 'user'")
    counts = audit.select("rows_inserted", "rows_updated", "rows_deleted")
    assert rows(counts) == [(0, 100, 0), (0, 100, 0), (0, 100, 0), (10_000, 0, 0)]


def test_the_base_is_read_without_a_shuffle(spark, keyed, capsys):
    keyed.apply(spark, FIRST, lambda _: spark.range(1000).selectExpr("cast(id as string) id", "'x' value"))
    put(spark, keyed, 1, ("1", "y"))
    keyed.read(spark).explain()
    plan = capsys.readouterr().out
    above_the_base = plan[plan.index("BroadcastHashJoin") : plan.index("FileScan")]
    assert "LeftAnti" in above_the_base and "Exchange" not in above_the_base


def test_changed_rows_are_those_of_the_merge(spark):
    users = table(
        spark,
        "id string, value string, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz",
        *[(str(i), "x", "2100-01-01", "2100-01-01", "2100-01-01" if i % 4 == 0 else None) for i in range(20)],
    )
    batch = table(
        spark,
        "id string, change_type string, changed_at timestamp_ntz, created_at timestamp_ntz, value string",
        *[(str(i), ("update", "delete", "insert")[i % 3], "2100-01-02", "2100-01-02", "y") for i in range(5, 30)],
    ).withColumn("set_columns", F.array(F.lit("value")))
    whole = ch.merge_changes(users, batch, "id", ["value"]).where(F.col(ch.APPLIED).isNotNull())
    assert rows(ch.changed_rows(users, batch, "id", ["value"])) == rows(whole)
    assert APPLIED_ON not in whole.columns
