"""Incremental tables: high watermark, delete+insert by key, recomputed days.

Tables are Parquet folders partitioned by a date column, in a folder of their version. A
batch rewrites only the days it touches, by dynamic partition overwrite with the complete
new content of each day (rows kept plus rows of the batch). The swap of several days is
not atomic, so a run notes where it starts and removes the note when it is complete;
after a crash the next run starts there again, and doing a batch twice gives the
same table as doing it once. A full refresh writes the next version beside the current
one, which stays readable until the new one is complete, and after a failure.
"""

from __future__ import annotations

import datetime as dt
import json
import operator
from collections.abc import Callable, Collection, Container, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keyindex import KeyIndex
from tidemark.schemas import timestamp
from tidemark.session import working_folder
from tidemark.sources import notes, paths
from tidemark.sources.tables import current_version, drop_old_versions, next_version, version_folder

# Up to this many keys of a batch are sent to every task; more are shuffled.
BROADCAST_KEYS = 2_000_000
# Notes of changed days that are kept apart.
MANY_NOTES = 32


@dataclass(frozen=True)
class IncrementalTable:
    """Where a table lives, the key a batch replaces rows by, its date column."""

    path: str
    keys: tuple[str, ...]
    day: str

    def exists(self, spark: SparkSession) -> bool:
        """Whether a first load was completed."""
        return current_version(spark, self.path) is not None

    def folder(self, spark: SparkSession) -> str:
        """Where the days of the current version are."""
        number = current_version(spark, self.path)
        if number is None:
            raise ValueError(f"{self.path} was not loaded yet")
        return version_folder(self.path, number)

    def index(self, spark: SparkSession) -> KeyIndex:
        return KeyIndex(f"{self.folder(spark)}/_index", self.keys, self.day)

    def _read(self, spark: SparkSession, folder: str, *folders: str) -> DataFrame:
        # The schema is kept beside the versions, so that no file is opened for planning.
        kept = paths.read_text(spark, self._schema_of(folder))
        reader = spark.read.schema(T.StructType.fromJson(json.loads(kept))).option("basePath", folder)
        return reader.parquet(*(folders or [folder]))

    def _schema_of(self, folder: str) -> str:
        return f"{self.path}/_schemas/{folder.rpartition('/')[2]}.json"

    def keep_schema(self, df: DataFrame, folder: str) -> None:
        """Note the columns of a version; the day is its last one."""
        columns = [f for f in df.schema if f.name != self.day] + [df.schema[self.day]]
        paths.write_text(df.sparkSession, self._schema_of(folder), T.StructType(columns).json())

    def read(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.folder(spark))

    def days(self, spark: SparkSession) -> list[dt.date | None]:
        """The days there are folders for, newest first, None last."""
        if not self.exists(spark):
            return []
        return paths.partition_days(spark, self.folder(spark), self.day)

    def read_days(self, spark: SparkSession, days: Container[dt.date | None]) -> DataFrame:
        """The rows of these days. Only their folders are listed, however many files
        the table has."""
        present = [d for d in self.days(spark) if d in days]
        if not present:
            return self.read(spark).where(F.lit(False))
        folder = self.folder(spark)
        return self._read(spark, folder, *[f"{folder}/{paths.day_folder(self.day, d)}" for d in present])


def latest_day(spark: SparkSession, table: IncrementalTable) -> dt.date | None:
    """The newest day that holds rows, from the folder names instead of a scan."""
    for day in table.days(spark):
        if not table.read_days(spark, [day]).isEmpty():
            return day
    return None


def high_watermark(spark: SparkSession, table: IncrementalTable, ts: str) -> dt.datetime | None:
    """The highest ``ts`` within the newest day that holds rows; one partition is read."""
    for day in table.days(spark):
        # As text, so that no time zone of the driver gets in between.
        highest = table.read_days(spark, [day]).agg(F.max(ts).cast("string")).first()[0]
        if highest is not None:
            return dt.datetime.fromisoformat(highest)
    return None


def newer_than(
    df: DataFrame, ts: str, watermark: dt.datetime | None, lookback: dt.timedelta | None = None
) -> DataFrame:
    """Rows strictly after the watermark; ties and late rows fall away.

    No watermark (no table, or an empty one) means all rows. ``lookback`` moves the
    watermark back to pick up late rows, which replace themselves by key.
    """
    if watermark is None:
        return df
    after = watermark - (lookback or dt.timedelta())
    return df.where(F.col(ts) > timestamp(after.isoformat(sep=" ")))


def since_day(df: DataFrame, day: str, last_day: dt.date | None) -> DataFrame:
    """Rows of the last day and newer; reaches the scan as a partition filter."""
    return df if last_day is None else df.where(F.col(day) >= F.lit(last_day))


def _listed(days: DataFrame) -> set[dt.date | None]:
    # At most one row per calendar day, and one for rows without a day.
    return {row[0] for row in days.distinct().collect()}


def _on(day: str, days: Iterable[dt.date | None]) -> Column:
    """Whether a row is of one of these days; never NULL."""
    found = F.coalesce(F.col(day).isin([d for d in days if d is not None]), F.lit(False))
    return found | F.col(day).isNull() if None in days else found


def _write(df: DataFrame, table: IncrementalTable, folder: str, mode: str) -> None:
    # The hint sizes files by data volume: small days share a task, and a day
    # with very many rows is split over several.
    (
        df.hint("rebalance", table.day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(table.day)
        .parquet(folder)
    )


def full_refresh(df: DataFrame, table: IncrementalTable) -> None:
    """Build the table from nothing, beside the one there is, which ``df`` may read.

    The version before is kept for those that still read it. What follows the table by
    days has to follow all of it; that is noted first, as a day too many does no harm.
    """
    spark = df.sparkSession
    note_days(spark, table, None)
    folder = version_folder(table.path, next_version(spark, table.path))
    # The version counts with its success marker; readers need the schema from then on.
    table.keep_schema(df, folder)
    _write(df, table, folder, "static")
    if table.day not in table.keys:
        rows = table.read(spark)
        table.index(spark).add(rows, rows.count())
    _completed(spark, table)
    drop_old_versions(spark, table.path)


@dataclass(frozen=True)
class DayUpdate:
    """The complete new content of some days.

    ``shrinking`` are the days that only lose rows; these may end up empty. ``batch``
    are the rows that came, ``count`` of them, if the table is indexed by their key.
    """

    content: DataFrame
    days: frozenset[dt.date | None]
    shrinking: frozenset[dt.date | None] = field(default_factory=frozenset)
    batch: DataFrame | None = None
    count: int = 0


@contextmanager
def merged_days(batch: DataFrame, table: IncrementalTable) -> Iterator[DayUpdate]:
    """What the table's days look like after the batch; the table must exist.

    Rows of a batch key are removed wherever they are, also on days the batch does
    not reach itself (an event sent again with a later time leaves its old day).
    The index tells which days these are; only their keys are read.
    """
    spark = batch.sparkSession
    # Written out once: the batch is used several times, may depend on the table it
    # changes, and as files it has a known size.
    folder = working_folder(spark)
    try:
        batch.write.parquet(folder)
        batch = spark.read.schema(batch.schema).parquet(folder)
        keys = list(table.keys)
        keyless = reduce(operator.or_, [F.col(key).isNull() for key in keys])
        counted = batch.groupBy(table.day).agg(F.count("*"), F.count_if(keyless))
        # At most one row per calendar day, and one for rows without a day.
        rows_of = {day: (rows, without) for day, rows, without in counted.collect()}
        days = set(rows_of)
        count, without = (sum(n[i] for n in rows_of.values()) for i in range(2))
        if not count:
            yield DayUpdate(batch, frozenset())
            return
        batch_keys = batch.select(*keys)
        if count <= BROADCAST_KEYS:
            # The whole table is then searched without shuffling it.
            batch_keys = F.broadcast(batch_keys)
        shrinking = set()
        indexed = None
        if table.day not in keys:
            indexed = table.index(spark).days_of(batch_keys, count)
            if indexed is None:
                others = table.read(spark).where(~_on(table.day, days))
            else:
                others = table.read_days(spark, indexed - days)
            if indexed is None or indexed - days:
                holding = others.join(batch_keys, keys, "left_semi")
                shrinking = _listed(holding.select(table.day))
        before = table.read_days(spark, days | shrinking)
        kept = before.join(batch_keys, keys, "left_anti")
        if without:
            # A row without its key is known by all it holds, so a batch that comes
            # again does not double it.
            names = {name: f"_b_{name}" for name in batch.columns}
            again = batch.where(keyless).withColumnsRenamed(names)
            same = [F.col(name).eqNullSafe(F.col(new)) for name, new in names.items()]
            kept = kept.join(again, reduce(operator.and_, same), "left_anti")
        content = kept.unionByName(batch)
        yield DayUpdate(
            content,
            frozenset(days | shrinking),
            frozenset(shrinking),
            None if indexed is None else batch,
            count,
        )
    finally:
        paths.remove(spark, folder)


def replace_days(update: DayUpdate, table: IncrementalTable) -> None:
    """Put the new content in place of the old, for exactly these days."""
    if not update.days:
        return
    spark = update.content.sparkSession
    if update.batch is not None:
        # Before the rows: a day too many in the index does no harm, one too few would.
        table.index(spark).add(update.batch, update.count)
    emptied = set()
    if update.shrinking:
        some = update.content.where(_on(table.day, update.shrinking))
        emptied = update.shrinking - _listed(some.select(table.day))
    nothing = update.content.drop(table.day).limit(0)
    folder = table.folder(spark)
    _write(update.content, table, folder, "dynamic")
    # An overwrite does not touch a day it has no rows for, so a day that lost its
    # last row is replaced by an empty file of its own.
    for day in emptied & set(table.days(spark)):
        nothing.write.mode("overwrite").parquet(f"{folder}/{paths.day_folder(table.day, day)}")


def delete_insert(batch: DataFrame, table: IncrementalTable) -> frozenset[dt.date | None] | None:
    """Replace the rows whose key is in the batch, then add the batch.

    Returns the days that changed, None for all; they are also noted beside the table.
    """
    spark = batch.sparkSession
    if not table.exists(spark):
        full_refresh(batch, table)
        return None
    with merged_days(batch, table) as update:
        # Noted first: a day too many is computed for nothing, one too few is wrong.
        note_days(spark, table, update.days)
        replace_days(update, table)
    return update.days


def _starting_point(spark: SparkSession, table: IncrementalTable, found: str | None) -> str | None:
    """Where this run starts: at the note of a run that broke off, else at ``found``."""
    folder = f"{table.path}/_started"
    points = notes.read(spark, folder)
    if points:
        return points[min(points)]
    notes.add(spark, folder, found)
    return found


def _completed(spark: SparkSession, table: IncrementalTable) -> None:
    paths.remove(spark, f"{table.path}/_started")


def load_new_rows(
    source: DataFrame,
    table: IncrementalTable,
    ts: str,
    prepare: Callable[[DataFrame], DataFrame],
    refresh: bool = False,
    lookback: dt.timedelta | None = None,
) -> frozenset[dt.date | None] | None:
    """Append-after-watermark with replacement by key; all rows on the first run.

    Returns the days to follow, None for all: those that changed, and those of earlier
    runs until :func:`days_followed` is called. What is computed from the table can then
    follow it, even after a run that broke off.
    """
    spark = source.sparkSession
    if refresh or not table.exists(spark):
        full_refresh(prepare(source), table)
        return None
    found = high_watermark(spark, table, ts)
    point = _starting_point(spark, table, found.isoformat() if found else None)
    watermark = dt.datetime.fromisoformat(point) if point else None
    delete_insert(prepare(newer_than(source, ts, watermark, lookback)), table)
    _completed(spark, table)
    return changed_days(spark, table)


def note_days(
    spark: SparkSession, table: IncrementalTable, days: frozenset[dt.date | None] | None
) -> None:
    """Note that these days change, None for all; earlier notes stay as they are.

    Of a table that nothing follows, the notes are now and then merged into one.
    """
    folder = f"{table.path}/_changed"

    def add(some: frozenset[dt.date | None] | None) -> None:
        listed = None if some is None else [None if d is None else d.isoformat() for d in some]
        notes.add(spark, folder, {"days": listed})

    if days is None or days:
        add(days)
    noted = _noted_days(spark, table)
    if len(noted) > MANY_NOTES:
        add(_merged(noted.values()))
        notes.drop(spark, folder, noted)


def _merged(days: Collection[frozenset | None]) -> frozenset[dt.date | None] | None:
    return None if None in days else frozenset().union(*days)


def _noted_days(spark: SparkSession, table: IncrementalTable) -> dict[int, frozenset | None]:
    def parsed(listed: list[str | None]) -> frozenset[dt.date | None]:
        return frozenset(None if d is None else dt.date.fromisoformat(d) for d in listed)

    found = notes.read(spark, f"{table.path}/_changed")
    return {number: None if n["days"] is None else parsed(n["days"]) for number, n in found.items()}


def changed_days(
    spark: SparkSession, table: IncrementalTable
) -> frozenset[dt.date | None] | None:
    """The days that changed since they were last followed, None for all."""
    return _merged(_noted_days(spark, table).values()) if table.exists(spark) else None


def days_followed(
    spark: SparkSession, table: IncrementalTable, days: frozenset[dt.date | None] | None = None
) -> None:
    """Everything computed from the table is up to date, or is so on these days.

    Only notes that name no other day are dropped, so that days which changed meanwhile
    are still known. Broken off in between, some days are followed twice.
    """
    noted = _noted_days(spark, table)
    done = [n for n, of in noted.items() if days is None or (of is not None and of <= days)]
    notes.drop(spark, f"{table.path}/_changed", done)


def recompute_days(
    source: DataFrame,
    table: IncrementalTable,
    source_day: str,
    aggregate: Callable[[DataFrame], DataFrame],
    days: frozenset[dt.date | None] | None,
) -> None:
    """Aggregate these days again, None for all, and put the outcome in their place.

    The outcome is all there is of these days, so nothing is compared with what they
    held: keys that are NULL or gone need no treatment of their own.
    """
    spark = source.sparkSession
    if days is None or not table.exists(spark):
        full_refresh(aggregate(source), table)
    elif days:
        content = aggregate(source.where(_on(source_day, days)))
        replace_days(DayUpdate(content, frozenset(days), frozenset(days)), table)


def recompute_recent_days(
    source: DataFrame,
    table: IncrementalTable,
    source_day: str,
    aggregate: Callable[[DataFrame], DataFrame],
    refresh: bool = False,
) -> None:
    """Aggregate the newest day of the table and all later ones again."""
    spark = source.sparkSession
    if refresh or not table.exists(spark):
        full_refresh(aggregate(source), table)
        return
    found = latest_day(spark, table)
    point = _starting_point(spark, table, found.isoformat() if found else None)
    last_day = dt.date.fromisoformat(point) if point else None
    # The days it holds and those the source has now.
    days = _listed(since_day(source, source_day, last_day).select(source_day))
    held = {d for d in table.days(spark) if last_day is None or (d is not None and d >= last_day)}
    recompute_days(source, table, source_day, aggregate, frozenset(days | held))
    _completed(spark, table)
