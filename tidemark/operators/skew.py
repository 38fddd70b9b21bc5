"""Hot keys: find them before a join is planned and spread them over many tasks.

A hash shuffle sends all rows of a key to one task, which fails when one key
holds a large share of the rows. Here the groups are counted on a sample, combined
map side; only heavy ones are then cut into finer groups. The count decides placement
and never results: all rows take part either way.

Aggregations need none of this. Spark combines their rows before the shuffle, so
a hot key arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import working_folder

# Rows of one group that a single task takes without being split.
ROWS_PER_GROUP = 4_000_000
# Up to this many heavy groups go through the driver to every task, 12 bytes each; more
# stay a table and are joined like any other.
BROADCAST_GROUPS = 100_000
# Rows by which a group just above the limit is recognised. Its size is then
# known to about one percent, so there is no need to count more of them.
RECOGNISED_BY = 20_000


class HeavyGroups:
    """Groups to be split: the columns with their types, and ``(_hash of these, _splits)``."""

    def __init__(self, columns: dict[str, T.DataType], groups: DataFrame, few: bool, some: bool):
        self.columns = columns
        self.groups = groups
        self.few = few
        self._some = some

    def __bool__(self) -> bool:
        return self._some

    def sized(self, df: DataFrame) -> DataFrame:
        """A table with a row per heavy group, to be broadcast if these are few."""
        return F.broadcast(df) if self.few else df

    def mark(self, df: DataFrame, name: str) -> DataFrame:
        """Add the splits of each row's group as ``name``, NULL if it is not heavy."""
        if not self:
            return df.withColumn(name, F.lit(None).cast("int"))
        # Equal values of different types would have different hashes.
        typed = [F.col(column).try_cast(kind) for column, kind in self.columns.items()]
        lookup = self.sized(self.groups.withColumnRenamed("_splits", name))
        return df.join(lookup, F.xxhash64(*typed) == F.col("_hash"), "left").drop("_hash")


def heavy_groups(
    df: DataFrame, columns: Sequence[str], rows_per_group: int = ROWS_PER_GROUP
) -> HeavyGroups:
    """The groups with more than ``rows_per_group`` rows.

    Counted on as large a fraction of the rows as recognises them; what is shuffled
    is a row per group and task of that sample.
    """
    fraction = min(1.0, RECOGNISED_BY / rows_per_group)
    counted = df if fraction == 1.0 else df.sample(fraction, seed=1)
    limit = rows_per_group * fraction
    counts = counted.groupBy(F.xxhash64(*columns).alias("_hash")).agg(F.count("*").alias("_n"))
    heavy = counts.where(F.col("_n") > limit).select(
        "_hash", F.ceil(F.col("_n") / limit).cast("int").alias("_splits")
    )
    spark, schema = df.sparkSession, "_hash bigint, _splits int"
    found = heavy.limit(BROADCAST_GROUPS + 1).collect()
    few = len(found) <= BROADCAST_GROUPS
    if few:
        groups = spark.createDataFrame(found, schema)
    else:
        # Written, so that every use sees the same groups.
        path = f"{working_folder(spark)}/heavy"
        heavy.write.parquet(path)
        groups = spark.read.schema(schema).parquet(path)
    kinds = {name: df.schema[name].dataType for name in columns}
    return HeavyGroups(kinds, groups, few, bool(found))


def slot_of(splits: str, spread_by: Sequence[str]) -> Column:
    """The split a row goes to: the same one whenever the row is computed again."""
    slot = F.pmod(F.xxhash64(*spread_by), F.col(splits)).cast("int")
    return F.coalesce(slot, F.lit(0))


def all_slots(splits: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(splits), F.lit(1)) - 1))


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: Sequence[str],
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """Left join to a lookup with unique ``on``, hot keys of ``left`` spread out.

    Each row of a heavy key goes to one of the key's slots, and the single lookup
    row of that key is repeated once per slot. NULL counts as a key here, so many
    rows without a key do not meet in one task either.
    """
    heavy = heavy_groups(left, [on], rows_per_group)
    if not heavy:
        return left.join(right, on, "left")
    placed = heavy.mark(left, "_splits").withColumn("_slot", slot_of("_splits", spread_by))
    copies = heavy.mark(right, "_splits").withColumn("_slot", all_slots("_splits"))
    joined = placed.drop("_splits").join(copies.drop("_splits"), [on, "_slot"], "left")
    return joined.drop("_slot")
