"""Shards against the same law in lists: stretches of one order, cut where the bytes say so."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
from conftest import FOLDER, ODD
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import sharding
from tidemark.llm.queries import registered


def size():
    return F.coalesce(F.octet_length("text"), F.lit(0)) + 8


def shards_of(documents, shards=24, **options):
    keep = {"doc_id": F.col("doc_id"), "text": F.col("text"), "key": F.xxhash64("text")}
    return sharding.sharded(documents, shards, size(), F.xxhash64("text"), "doc_id", keep, **options).collect()


def check(rows, shards, tolerance=sharding.TOLERANCE):
    """Slots are gapless, shards are stretches of the order, their ends near their places."""
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r)
    assert set(by_shard) <= set(range(shards))
    order = []
    for shard in sorted(by_shard):
        own = sorted(by_shard[shard], key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        order += own
    keys = [(r["key"], r["doc_id"] is not None, r["doc_id"] or 0) for r in order]
    assert keys == sorted(keys)
    total = sum(r["size"] for r in rows)
    below = [0, *accumulate(r["size"] for r in order)]
    for i in range(1, shards):
        end = sum(r["size"] for s in range(i) for r in by_shard[s])
        # No boundary between two rows is nearer, or it is within the tolerance.
        nearest = min(abs(total * i / shards - b) for b in below)
        assert abs(end - total * i / shards) <= max(nearest, tolerance * total / shards) + 1e-6


def test_given_documents(spark, given):
    rows = registered()["op12_histogram_shards"](spark, FOLDER).collect()
    known = {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t, _ in given}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == known
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    keys = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", F.xxhash64("text")).collect())
    check([r.asDict() | {"key": keys[r["doc_id"]]} for r in rows], 24)


@pytest.mark.parametrize("shards", [1, 2, 24, 100])
def test_odd_documents(documents, shards):
    rows = shards_of(documents, shards)
    check(rows, shards)
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(ODD)


def test_no_rows(nothing):
    assert shards_of(nothing) == []


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: 7, lambda i: None, lambda i: (-1) ** i * 2**62 + i])
def test_a_group_of_copies_is_cut(spark, ids):
    """A third of all rows are equal, with ids of their own, one id or none."""
    rows = [(ids(i), "a copy of one text") for i in range(1000)] + [(i, f"text {i} " * (i % 9)) for i in range(2000)]
    random.Random(3).shuffle(rows)
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = shards_of(documents, 24)
    check(found, 24)
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(rows)


def test_groups_stay_together_where_the_tolerance_allows(spark):
    rows = [(i, f"text {i // 5}") for i in range(5000)]
    found = shards_of(spark.createDataFrame(rows, "doc_id bigint, text string"), 10, tolerance=0.02)
    shards = defaultdict(set)
    for r in found:
        shards[r["text"]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())
    check(found, 10, 0.02)


def test_parts_of_a_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 50)
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(3000)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    placed = sharding.sharded(documents, 6, size(), F.xxhash64("text"), "doc_id")
    assert placed.select("document.*").columns == ["doc_id", "text"]
    found = shards_of(documents, 6)
    check(found, 6)


def test_a_row_larger_than_a_shard(spark):
    rows = [(0, "x" * 100_000), *((i, "small") for i in range(1, 40))]
    found = shards_of(spark.createDataFrame(rows, "doc_id bigint, text string"), 8)
    check(found, 8)


def test_ids_that_are_text(spark):
    rows = [(f"id{i}", "one text") for i in range(300)] + [(None, None)] * 9
    found = shards_of(spark.createDataFrame(rows, "doc_id string, text string"), 4)
    assert sorted(Counter(r["shard"] for r in found)) == [0, 1, 2, 3] and len(found) == 309


@settings(max_examples=100, deadline=None)
@drawn(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 50)), min_size=1, max_size=60), st.floats(0, 1))
def test_refining_ends_at_the_nearest_boundary(rows, share):
    total = sum(size for _, size in rows)
    splitter = sharding.Splitter(total * share, 0.0)
    for shift in (6, 3, 0):
        bins = defaultdict(lambda: [0, 0])
        for key, size in rows:
            if splitter.bin is None or key >> (shift + 3) == splitter.bin:
                bins[key >> shift][0] += size
                bins[key >> shift][1] += 1
        splitter = sharding._refined(splitter, sharding.Bins.of([(b, *v) for b, v in bins.items()]), shift)
        if splitter.boundary:
            break
    if splitter.boundary:
        below = sum(size for key, size in rows if key < splitter.boundary[0])
        assert below == splitter.bytes
        assert sum(key < splitter.boundary[0] for key, _ in rows) == splitter.rows
        edges = [0, *accumulate(size for _, size in sorted(rows))]
        if len({key for key, _ in rows}) == len(rows):
            assert abs(below - splitter.target) == min(abs(e - splitter.target) for e in edges)
    else:
        assert len(splitter.prefix) == 1


def test_shards_are_written_as_folders(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(200)]
    placed = sharding.sharded(
        spark.createDataFrame(rows, "doc_id bigint, text string"), 5, size(), F.xxhash64("text"), "doc_id"
    )
    sharding.write(placed, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert Counter(back.select("document.doc_id", "document.text").collect()) == Counter(rows)
    assert (tmp_path / "shards" / "shard=4").exists()
