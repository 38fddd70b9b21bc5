"""Exact distinct counts that can be stored and merged.

The keys of a group are a set of bits, in bitmaps of 32,768 keys each. Bitmaps of days
merge into those of months or years by or, and the bits of a set count its keys exactly,
so a longer period is never counted from its rows again. Both steps are aggregations that
every task begins on its own rows.

Keys are whole numbers. Others get a number first (:func:`numbered`), once and for all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import read_table, write_table

BUCKET, BITS = "bucket", "bits"


def bitmaps(df: DataFrame, groups: list[str], key: str) -> DataFrame:
    """``(groups, bucket, bits)``: the keys of each group; NULL is no key."""
    bucket = F.bitmap_bucket_number(key).alias(BUCKET)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(BITS)
    return df.where(F.col(key).isNotNull()).groupBy(*groups, bucket).agg(bits)


def merged(sets: DataFrame, groups: list) -> DataFrame:
    """The sets of coarser groups, ``groups`` being names or expressions over the finer ones."""
    return sets.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(sets: DataFrame, groups: list, name: str) -> DataFrame:
    """Distinct keys of each group, from the sets of the same or finer groups."""
    whole = merged(sets, groups)
    names = [c for c in whole.columns if c not in (BUCKET, BITS)]
    return whole.groupBy(*names).agg(F.sum(F.bitmap_count(BITS)).alias(name))


@dataclass(frozen=True)
class Numbers:
    """A stored table of keys of any kind with a number each, which they keep."""

    path: str
    key: str

    def read(self, spark: SparkSession) -> DataFrame | None:
        return read_table(spark, self.path)

    def add(self, keys: DataFrame) -> DataFrame:
        """Numbers the keys that have none yet; returns all numbers.

        Numbers grow within a task and have gaps between tasks and between calls, so
        that no task has to know how many keys the others have.
        """
        spark = keys.sparkSession
        known = self.read(spark)
        new = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        start = 0
        if known is not None:
            new = new.join(known, self.key, "left_anti")
            start = 1 + (known.agg(F.max("number")).first()[0] or 0)
        numbered_ = new.withColumn("number", F.monotonically_increasing_id() + F.lit(start))
        write_table(numbered_ if known is None else known.unionByName(numbered_), self.path)
        return self.read(spark)


def numbered(df: DataFrame, numbers: DataFrame, key: str) -> DataFrame:
    """Adds ``number``, NULL for keys that were never numbered."""
    return df.join(numbers, key, "left")
