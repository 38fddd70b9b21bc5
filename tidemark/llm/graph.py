"""Connected components of a graph given by its links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _smallest_neighbour(links: DataFrame) -> DataFrame:
    """For each node the smallest of itself and its neighbours; combined map side."""
    return links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))


def components(links: DataFrame) -> DataFrame:
    """The smallest node each linked node can reach: (node, root).

    ``links`` has the columns a and b of one orderable type. Alternates linking the
    larger neighbours of a node to its smallest one, and the smaller ones; both keep
    what is connected. Each round is written to the shared folder. A node with very
    many neighbours is combined before the shuffle, and its links are joined to a
    single row, which adaptive execution splits; no neighbour list is ever built.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        # Larger neighbours to the smallest one.
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_smallest_neighbour(both), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        large = stored(large, "large")
        # The node and its smaller neighbours to the smallest one.
        low = _smallest_neighbour(large)
        small = (
            large.join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b")))
            .where("a <> b")
            .distinct()
        )
        small = stored(small, "small")
        if _same(links, small):
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = small


def _digest(links: DataFrame):
    # One row: how many links, and an order-free checksum that cannot overflow.
    return links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 31) - 1)), F.bit_xor(F.xxhash64("a", "b"))
    ).first()


def _same(one: DataFrame, other: DataFrame) -> bool:
    return _digest(one) == _digest(other)
