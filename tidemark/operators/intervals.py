"""Version intervals from a change feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.attributes import version_id
from tidemark.functions.calendar import microsecond_number
from tidemark.operators.skew import ROWS_PER_GROUP, heavy_groups
from tidemark.schemas import SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO, open_end
from tidemark.session import working_folder

# Stretches of a hot key hold 2 to the power of so many microseconds: from 35 years down
# to a single one, each a 64th of the one before.
SHIFTS = tuple(range(50, -1, -6)) + (0,)


def last_per_group(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The last row of each group in the given order.

    An aggregation instead of a ranking window: every task first keeps one row
    per group, so a group with very many rows is never gathered anywhere.
    """
    rest = [name for name in df.columns if name not in group]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*group).agg(last.alias("_last")).select(*group, "_last.*").select(df.columns)


def first_per_group(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    rest = [name for name in df.columns if name not in group]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return (
        df.groupBy(*group).agg(first.alias("_first")).select(*group, "_first.*").select(df.columns)
    )


def _lead_within(df: DataFrame, group: list[str], at: str, order: list[str]) -> DataFrame:
    """Add ``_next``, the next time in the group, and ``_is_first``."""
    own = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_next", F.lead(at).over(own)).withColumn(
        "_is_first", F.first(at).over(own) == F.col(at)
    )


def _slot(at: str, shift: int) -> Column:
    return F.shiftright(microsecond_number(F.col(at)), shift)


def _shift_for(points: DataFrame, key: str, at: str, rows_per_group: int, below: int) -> int:
    """The longest stretches in which no group is heavy, longer ones than of ``below``.

    Counted by halving the list: short stretches never hold more than long ones. The
    shortest allowed hold 64 points at most, one of each stretch below.
    """
    shifts = [s for s in SHIFTS if s > below] or [62]
    first, last = 0, len(shifts) - 1
    while first < last:
        middle = (first + last) // 2
        placed = points.withColumn("_slot", _slot(at, shifts[middle]))
        if heavy_groups(placed, [key, "_slot"], rows_per_group):
            first = middle + 1
        else:
            last = middle
    return shifts[first]


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written and read again: what is counted several times is computed once."""
    path = f"{working_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _linked(
    rows: DataFrame, points: DataFrame, key: str, at: str, rows_per_group: int, below: int = -1
) -> DataFrame:
    """Add ``_next`` and ``_is_first`` to rows of distinct times per key, in bounded groups.

    ``points`` are the key and time of the rows with ``_cut``. These are read in stretches of
    time. The last one of a stretch goes on at the first of the key's next stretch, and
    these firsts, one a stretch, are linked alike in longer stretches, until a key has few
    enough of them.
    """
    cut = F.col("_cut").isNotNull()
    shift = _shift_for(points, key, at, rows_per_group, below)
    placed = rows.withColumn("_slot", F.when(cut, _slot(at, shift)).otherwise(0))
    inside = _lead_within(placed, [key, "_slot"], at, [at])
    # A name for each level, as the slots of longer stretches stand beside those of shorter ones.
    of = f"_of_{shift}"
    firsts = points.groupBy(key, _slot(at, shift).alias(of), "_cut").agg(F.min(at).alias("_opens"))
    if heavy_groups(firsts, [key], rows_per_group):
        firsts = _kept(firsts, "firsts")
        firsts = _linked(firsts, firsts, key, "_opens", rows_per_group, shift)
    else:
        firsts = _lead_within(firsts, [key], "_opens", ["_opens"])
    later = firsts.select(
        F.col(key).alias("_key"), of, F.col("_next").alias("_later"), F.col("_is_first").alias("_opens_key")
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slot") == F.col(of)) & cut
    return (
        inside.join(later, same, "left")
        .withColumn("_next", F.coalesce("_next", "_later"))
        .withColumn("_is_first", F.col("_is_first") & F.coalesce("_opens_key", F.lit(True)))
        .drop("_slot", "_key", of, "_later", "_opens_key")
    )


def _neighbours(
    feed: DataFrame, key: str, updated_at: str, order: list[str], rows_per_group: int | None
) -> DataFrame:
    """Add ``_next``, the time of the key's next change, and ``_is_first``."""
    heavy = heavy_groups(feed, [key], rows_per_group) if rows_per_group else None
    if not heavy:
        return _lead_within(feed, [key], updated_at, order)
    # Of changes at one instant only the last counts; combined by every task, however
    # many there are. From here on the times of a key are distinct.
    instants = last_per_group(feed, [key, updated_at], order[1:] or [updated_at])
    times = heavy.mark(feed.select(key, updated_at), "_cut").where(F.col("_cut").isNotNull())
    points = _kept(times.distinct(), "points")
    return _linked(heavy.mark(instants, "_cut"), points, key, updated_at, rows_per_group)


def close_intervals(
    feed: DataFrame,
    key: str,
    updated_at: str,
    tiebreak: str | None = None,
    rows_per_group: int | None = ROWS_PER_GROUP,
    initial_valid_from: str | None = None,
) -> DataFrame:
    """Turn changes into versions that end where the key's next one begins.

    Of several changes at the same instant the one with the highest ``tiebreak``
    is kept; the others would have been valid for no time at all.
    ``initial_valid_from`` names the column a key's first version begins at instead,
    such as its creation; without it an event before the first update has no version.
    """
    order = [updated_at, tiebreak] if tiebreak else [updated_at]
    linked = _neighbours(feed, key, updated_at, order, rows_per_group)
    last_of_instant = F.col("_next").isNull() | (F.col("_next") > F.col(updated_at))
    opens = F.col(updated_at)
    if initial_valid_from is not None:
        opens = F.when(F.col("_is_first"), F.least(updated_at, initial_valid_from)).otherwise(opens)
    return linked.where(last_of_instant).select(
        *feed.columns,
        version_id(F.col(key), F.col(updated_at)).alias(SCD_ID),
        F.col(updated_at).alias(UPDATED_AT),
        opens.alias(VALID_FROM),
        F.coalesce("_next", open_end()).alias(VALID_TO),
    )


def history_from_feed(
    feed: DataFrame,
    key: str,
    updated_at: str,
    tiebreak: str,
    rows_per_group: int | None = ROWS_PER_GROUP,
    initial_valid_from: str | None = None,
) -> DataFrame:
    """Whole history from a change feed: one version per key and change time.

    Equals running :func:`~tidemark.operators.snapshots.snapshot_run` after every
    single change.
    """
    return close_intervals(
        feed, key, updated_at, tiebreak, rows_per_group, initial_valid_from
    )


def history_from_runs(
    feed: DataFrame,
    key: str,
    updated_at: str,
    run: Column,
    tiebreak: str,
    rows_per_group: int | None = ROWS_PER_GROUP,
) -> DataFrame:
    """History as snapshot runs see it: of the changes between two runs, the last.

    ``run`` maps a change to the run that first sees it.
    """
    seen = last_per_group(feed.withColumn("_run", run), [key, "_run"], [updated_at, tiebreak])
    return close_intervals(seen.drop("_run"), key, updated_at, None, rows_per_group)
