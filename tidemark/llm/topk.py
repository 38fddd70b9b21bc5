"""Exact top-k by inner product: ball trees per shard, branch and bound, shared scores.

The vectors are dealt into shards of a bounded size, and a task builds a ball tree over
one shard. A query visits the nodes in order of an upper bound of the inner product
(with the centre, plus its own length times the radius) and leaves out those that cannot
beat the k-th score it has. That score is shared between shards: a first pass answers
each query on one shard, and the k-th scores of it are the queries' starting bounds on
all others. Queries come in blocks of a bounded size; each block meets each shard once.

Scores are exact integers. Ties go to the smaller id.

Defined results: vectors that are NULL, or hold NULL, NaN or infinite components, and
rows without an id take no part. Vectors meet those of the same dimension only; empty
ones have the score 0. An id that comes several times counts once, with its smallest
vector. Fewer candidates than k: all of them. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF_ROWS = 64
# Numbers of this size are exact as 64-bit floats, and of that size as 64-bit integers.
_EXACT, _LONG = 1 << 53, 1 << 63
_NONE = -_LONG


def scaled(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component; NULL unless all are finite."""
    values = F.transform(vector, lambda x: x.cast("double") * factor)
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(values, lambda x: F.floor(x)))


@dataclass(frozen=True)
class BallTree:
    """Nodes with centre, radius and smallest id; leaves hold rows start to end."""

    vectors: np.ndarray
    ids: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    low_id: np.ndarray
    children: np.ndarray  # -1 for leaves
    start: np.ndarray
    end: np.ndarray


def build(vectors: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS) -> BallTree:
    """Splits at the median along the line between two far apart rows."""
    points = vectors.astype(np.float64)
    order = np.arange(len(ids))
    centres, radii, lows, children, starts, ends = [], [], [], [], [], []

    def add(start: int, end: int) -> int:
        own = points[order[start:end]]
        centre = own.mean(axis=0)
        radius = math.sqrt(float(((own - centre) ** 2).sum(axis=1).max(initial=0)))
        centres.append(centre)
        # Rounding must not make a ball smaller than what is in it.
        radii.append(radius * (1 + 1e-9) + 1e-6)
        lows.append(int(ids[order[start:end]].min()))
        children.append((-1, -1))
        starts.append(start)
        ends.append(end)
        return len(starts) - 1

    waiting = [add(0, len(ids))]
    while waiting:
        node = waiting.pop()
        start, end = starts[node], ends[node]
        if end - start <= leaf_rows or radii[node] <= 1e-5:
            rows = order[start:end]
            order[start:end] = rows[np.argsort(ids[rows])]
            continue
        own = points[order[start:end]]
        one = own[np.argmax(((own - centres[node]) ** 2).sum(axis=1))]
        other = own[np.argmax(((own - one) ** 2).sum(axis=1))]
        middle = (end - start) // 2
        order[start:end] = order[start:end][np.argpartition(own @ (other - one), middle)]
        halves = add(start, start + middle), add(start + middle, end)
        children[node] = halves
        waiting.extend(halves)
    return BallTree(
        vectors[order], ids[order], np.array(centres), np.array(radii), np.array(lows),
        np.array(children), np.array(starts), np.array(ends),
    )


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond 64 bits they stay at the largest number."""
    dimension = max(1, vectors.shape[1])
    bound = dimension * int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0))
    if bound < _EXACT:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if bound < _LONG:
        return queries @ vectors.T
    exact = queries.astype(object) @ vectors.T.astype(object)
    return np.clip(exact, -_LONG + 1, _LONG - 1).astype(np.int64)


def search(
    tree: BallTree, queries: np.ndarray, query_ids: np.ndarray, known: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids (queries x k) of the best rows of a tree, other than a query's own id.

    Rows below ``known``, the k-th score a query has from elsewhere, are left out.
    Unused places have the score _NONE.
    """
    count = len(query_ids)
    points = queries.astype(np.float64)
    norms = np.sqrt((points**2).sum(axis=1))
    scores = np.full((count, k), _NONE, np.int64)
    ids = np.zeros((count, k), np.int64)

    def bound(query: np.ndarray, node: np.ndarray) -> np.ndarray:
        middle = np.einsum("ij,ij->i", points[query], tree.centre[node])
        most = middle + norms[query] * tree.radius[node]
        return most + 1e-9 * np.abs(middle) + 1e-3

    # Down the tree, all queries at once, as far as the known scores let them.
    leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    query, node = np.arange(count), np.zeros(count, np.int64)
    while len(query):
        most = bound(query, node)
        open_ = most >= known[query]
        query, node, most = query[open_], node[open_], most[open_]
        leaf = tree.children[node, 0] < 0
        leaves.append((query[leaf], node[leaf], most[leaf]))
        query, node = np.repeat(query[~leaf], 2), tree.children[node[~leaf]].ravel()
    query, node, most = (np.concatenate(part) for part in zip(*leaves))
    # Then the leaves, each query's in order of the bound; one for each query at a time.
    order = np.lexsort((-most, query))
    query, node, most = query[order], node[order], most[order]
    first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    turn = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    by_turn = np.argsort(turn, kind="stable")
    cuts = np.searchsorted(turn[by_turn], np.arange(turn.max(initial=-1) + 2))
    for start, end in zip(cuts, cuts[1:]):
        here = by_turn[start:end]
        kth, kth_id = scores[query[here], k - 1], ids[query[here], k - 1]
        least = np.maximum(kth, known[query[here]])
        better = (np.floor(most[here]) > kth) | (tree.low_id[node[here]] < kth_id)
        here = here[(most[here] >= least) & better]
        for own in _by(here, node):
            rows = slice(tree.start[node[own[0]]], tree.end[node[own[0]]])
            asked = query[own]
            found = _products(queries[asked], tree.vectors[rows])
            found[tree.ids[rows][None, :] == query_ids[asked][:, None]] = _NONE
            all_scores = np.concatenate([scores[asked], found], axis=1)
            all_ids = np.concatenate([ids[asked], np.broadcast_to(tree.ids[rows], found.shape)], axis=1)
            best = np.lexsort((all_ids, -np.maximum(all_scores, _NONE + 1)), axis=1)[:, :k]
            scores[asked] = np.take_along_axis(all_scores, best, axis=1)
            ids[asked] = np.take_along_axis(all_ids, best, axis=1)
    return scores, ids


def _by(places: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
    """``places`` in groups of the same node."""
    if not len(places):
        return []
    ordered = places[np.argsort(node[places], kind="stable")]
    return np.split(ordered, np.flatnonzero(np.diff(node[ordered])) + 1)


def _distinct(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors; of an id that comes several times the smallest vector."""
    if frame["vec_id"].duplicated().any():
        keyed = frame.assign(key=frame["vector"].map(tuple)).sort_values(["vec_id", "key"])
        frame = keyed.drop_duplicates("vec_id")
    return frame["vec_id"].to_numpy(), np.stack(frame["vector"].to_numpy()).astype(np.int64)


_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _searched(k: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        for size, some in asked.groupby(asked["vector"].map(len)):
            same = rows[rows["vector"].map(len) == size]
            if same.empty:
                continue
            ids, vectors = _distinct(same)
            query_ids, queries = _distinct(some)
            known = some.drop_duplicates("vec_id").set_index("vec_id")["known"].loc[query_ids].to_numpy()
            scores, best = search(build(vectors, ids), queries, query_ids, known, k)
            used = scores > _NONE
            query = np.broadcast_to(query_ids[:, None], scores.shape)
            found.append(pd.DataFrame({"query_id": query[used], "vec_id": best[used], "score": scores[used]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return run


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The ``k`` best candidates of each query: query_id, rank (from 1), vec_id, score.

    Both have vec_id and vector, an array of whole numbers; a query's own id is no
    candidate of it.
    """

    def usable(df: DataFrame) -> DataFrame:
        whole = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
        return df.select(F.col("vec_id").cast("bigint"), F.col("vector").cast("array<bigint>")).where(
            whole & ~F.exists("vector", lambda x: x.isNull())
        )

    # Combined map side: of an id that comes very often, each task passes one row on.
    rows = usable(candidates).groupBy("vec_id", F.size("vector")).agg(F.min("vector").alias("vector"))
    rows = rows.select("vec_id", "vector")
    asked = usable(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    shards = max(1, math.ceil(rows.count() / shard_rows))
    blocks = max(1, math.ceil(asked.count() / block_queries))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dealt = rows.withColumn("shard", shard).withColumn("block", all_blocks)
    placed = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int"))

    def searched(placed_queries: DataFrame) -> DataFrame:
        there = placed_queries.groupBy("shard", "block")

        def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return _searched(k)(left, right)

        return dealt.groupBy("shard", "block").cogroup(there).applyInPandas(run, _FOUND)

    first = searched(placed.withColumn("shard", shard).withColumn("known", F.lit(_NONE)))
    if shards == 1:
        found = first
    else:
        first = stored(first, "first_pass")
        per_query = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        known = per_query.select(
            F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("kth")).alias("known")
        )
        elsewhere = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != shard)
        bounded = placed.join(known, "vec_id", "left").withColumn("known", F.coalesce("known", F.lit(_NONE)))
        found = first.unionByName(searched(bounded.withColumn("shard", F.explode(elsewhere))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
