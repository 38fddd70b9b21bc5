"""SimHash groups and top-k, against brute force."""

import re

import numpy as np
import xxhash
from conftest import FOLDER, ODD
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import graph, simhash, topk
from tidemark.llm.queries import registered


def fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)]
    shingles = shingles or ([" ".join(found)] if found else [])
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))


def groups(values, distance=3):
    """For each value the smallest index it is linked with."""
    label = list(range(len(values)))
    while True:
        before = list(label)
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= distance:
                    label[i] = min(label[i], label[j])
        if label == before:
            return label


def test_groups_of_given_documents(spark, given):
    prints = [fingerprint(t) for _, t, _ in given]
    found = registered()["op5_simhash_groups"](spark, FOLDER).orderBy("doc_id").collect()
    expected = [(g[0], f"{p:016x}", given[low][0]) for g, p, low in zip(given, prints, groups(prints))]
    assert [tuple(r) for r in found] == expected


def test_groups_of_odd_documents(documents, nothing):
    prints = [fingerprint(t) for _, t in ODD]
    labels = groups(prints)
    found = simhash.near_duplicates(documents).collect()
    expected = []
    for (doc_id, _), p, label in zip(ODD, prints, labels):
        ids = [i for (i, _), other in zip(ODD, labels) if other == label and i is not None]
        expected.append((doc_id, f"{p:016x}", min(ids, default=None)))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.without_near_duplicates(documents)
    assert kept.columns == documents.columns
    # 1, 2 and 4 have no words, 5 and 6 are near; repeated rows stay once.
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 5, 7, 8, 9, 10]
    assert simhash.without_near_duplicates(nothing).count() == 0


@settings(max_examples=40, deadline=None)
@drawn(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=5), st.randoms())
def test_links_of_one_value_connect_all_that_is_near(centres, random):
    own = {c ^ sum(1 << random.randrange(64) for _ in range(random.randrange(5))) & (2**64 - 1) for c in centres for _ in range(8)}
    values = sorted(own)
    a, b = simhash._linked(np.array(values, np.uint64), np.zeros(0, np.uint64), 3)
    label = {v: v for v in values}
    for _ in values:
        for x, y in zip(a.tolist(), b.tolist()):
            label[x] = label[y] = min(label[x], label[y])
    expected = groups(values)
    assert [label[v] for v in values] == [values[i] for i in expected]


def test_multi_index_finds_every_distance(spark):
    rng = np.random.default_rng(5)
    values = set()
    for centre in rng.integers(0, 2**63, 30, dtype=np.uint64).tolist():
        for flips in range(6):
            bits = rng.choice(64, flips, replace=False)
            values.add(centre ^ sum(1 << int(b) for b in bits))
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for distance, crowd in ((0, 1000), (1, 1000), (3, 1000), (4, 1000), (3, 0), (3, 3), (2, 2), (4, 2)):
        roots = graph.components(simhash.near_links(fps, distance, crowd)).collect()
        label = dict(zip(signed, signed)) | {r["node"]: r["root"] for r in roots}
        found, expected = {}, {}
        for v, low in zip(signed, groups(values, distance)):
            found.setdefault(label[v], set()).add(v)
            expected.setdefault(low, set()).add(v)
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_one_id_with_several_texts(spark):
    near = lambda start: [" ".join(f"{start}{i % 977}" for i in range(3000)) + more for more in ("", " more")]
    (a, a_), (c, c_), b = near("word"), near("other"), "quite another text that is like none"
    docs = spark.createDataFrame([(3, a), (5, a_), (5, b), (7, c), (7, c_), (7, c)], "doc_id bigint, text string")
    groups_of = {r["fingerprint"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(groups_of.values()).count(3) == 2 or len(groups_of) < 5  # a and a_ are near
    kept = [tuple(r) for r in simhash.without_near_duplicates(docs).collect()]
    assert len(kept) == 3 and (3, a) in kept and (5, b) in kept
    assert ((7, c) in kept) != ((7, c_) in kept)


def test_components_of_a_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = graph.components(links.where("a <> 150"))
    assert {r["node"]: r["root"] for r in found.collect()} == {
        **{i: 0 for i in range(1, 151)}, **{i: 151 for i in range(152, 301)}
    }
    assert graph.components(links.where("false")).count() == 0


def best(rows, query_ids, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None:
            vectors[i] = min(vectors.get(i, v), v)
    found = []
    for q in sorted(query_ids & vectors.keys()):
        scores = sorted(
            (-sum(a * b for a, b in zip(v, vectors[q])), i)
            for i, v in vectors.items()
            if i != q and len(v) == len(vectors[q])
        )
        found += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return found


def test_top_k_of_given_vectors(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    vectors = [(r["vec_id"], [int(np.floor(256 * float(x))) for x in r["embedding"]]) for r in rows]
    found = registered()["op1_ball_tree_top_k"](spark, FOLDER).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == best(vectors, {i for i, _ in vectors if i % 50 == 0}, 5)


def test_top_k_over_shards_with_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 4).tolist()) for i in range(700)]
    rows += [(1000 + i, [2, 2, 2, 2]) for i in range(200)]  # one common vector
    rows += [(5, [9, 9, 9, 9]), (7, [-9, 0, 0, 0]), (2000, [1, 2]), (2001, [3, 4]), (None, [1, 1, 1, 1]), (2002, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>").repartition(4)
    asked = df.where("vec_id % 10 = 0 or vec_id = 2001")
    found = topk.top_k(df, asked, k=5, shard_rows=100, block_queries=30).orderBy("query_id", "rank").collect()
    ids = {i for i, _ in rows if i is not None and (i % 10 == 0 or i == 2001)}
    assert [tuple(r) for r in found] == best(rows, ids, 5)
    assert topk.top_k(df.where("false"), asked.where("false")).count() == 0


def test_an_id_that_holds_most_rows_is_one_candidate(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 4).tolist()) for i in range(300)]
    heavy = [(11, rng.integers(-50, 50, 4).tolist()) for _ in range(3000)]
    once = [*(r for r in rows if r[0] != 11), (11, min([rows[11][1], *(v for _, v in heavy)]))]
    df = spark.createDataFrame(rows + heavy, "vec_id bigint, vector array<bigint>").repartition(4)
    asked = df.where("vec_id % 10 = 1")
    found = topk.top_k(df, asked, k=5, shard_rows=100, block_queries=7).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == best(once, {i for i, _ in once if i % 10 == 1}, 5)


def test_scaling_leaves_out_what_is_not_finite(spark):
    rows = [(1, [0.5, -0.001]), (2, None), (3, [1.0, None]), (4, [float("nan")]), (5, [float("inf")]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = df.select("vec_id", topk.scaled(F.col("embedding")).alias("v")).collect()
    assert [tuple(r) for r in found] == [(1, [128, -1]), (2, None), (3, None), (4, None), (5, None), (6, [])]


def test_products_are_exact_beyond_floats():
    big = np.array([[1 << 40, 1]], np.int64)
    assert topk._products(big, np.array([[1 << 20, 3]], np.int64))[0, 0] == (1 << 60) + 3
    assert topk._products(big, np.array([[1 << 40, 3]], np.int64))[0, 0] == (1 << 63) - 1
