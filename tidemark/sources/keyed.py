"""A table of current rows by key: a base, and the rows that changed since, day by day.

Days are dates, or whole numbers such as those of microbatches. A day adds the rows it changed, whole and under its date, and leaves all others alone.
Reading takes the newest row of each changed key, and from the base those whose key did
not change; the base is not shuffled for that while the changes are few. Once they are a
share of the base, or many days, the next day begins by writing a new base from both. Days
count once they are complete and are applied once, so a run that broke off is repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import paths

Day = dt.date | int

# The day a row was last changed on.
APPLIED_ON = "applied_on"
_BASE, _CHANGES = "base-", "changes-"


@dataclass(frozen=True)
class KeyedTable:
    """``fold_share`` is the size of changes against the base, ``fold_days`` their number,
    from which on they are folded into a new base."""

    path: str
    key: str
    fold_share: float = 0.25
    fold_days: int = 32

    def _folder(self, kind: str, day: Day) -> str:
        return f"{self.path}/{kind}{day}"

    def _days(self, spark: SparkSession, kind: str) -> list[Day]:
        """The days with a complete folder of this kind, in order."""
        found = [n.removeprefix(kind) for n in paths.names(spark, self.path) if n.startswith(kind)]
        days = sorted(int(n) if n.isdigit() else dt.date.fromisoformat(n) for n in found)
        return [d for d in days if paths.exists(spark, f"{self._folder(kind, d)}/_SUCCESS")]

    def _base_day(self, spark: SparkSession) -> Day | None:
        return max(self._days(spark, _BASE), default=None)

    def last(self, spark: SparkSession) -> Day | None:
        """The newest day that was applied."""
        return max(self._days(spark, _BASE) + self._days(spark, _CHANGES), default=None)

    def _changes_since(self, spark: SparkSession, base: Day) -> list[str]:
        return [self._folder(_CHANGES, d) for d in self._days(spark, _CHANGES) if d > base]

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The current rows with the day of their last change; None before the first load."""
        day = self._base_day(spark)
        if day is None:
            return None
        base = spark.read.parquet(self._folder(_BASE, day))
        folders = self._changes_since(spark, day)
        if not folders:
            return base
        changes = spark.read.schema(base.schema).parquet(*folders)
        row = F.struct(*base.columns)
        newest = (
            changes.where(F.col(self.key).isNotNull())
            .groupBy(self.key)
            .agg(F.max_by(row, APPLIED_ON).alias("row"))
            .select("row.*")
        )
        # A row without a key replaces nothing.
        keyless = changes.where(F.col(self.key).isNull())
        unchanged = base.join(changes.select(self.key), self.key, "left_anti").select(base.columns)
        return unchanged.unionByName(newest).unionByName(keyless)

    def of_day(self, spark: SparkSession, day: Day) -> DataFrame | None:
        """The rows that changed last on this day; None if it was not applied yet."""
        if day in self._days(spark, _CHANGES):
            return spark.read.parquet(self._folder(_CHANGES, day))
        base = self._base_day(spark)
        if base is None or day > base:
            return None
        return spark.read.parquet(self._folder(_BASE, base)).where(F.col(APPLIED_ON) == F.lit(day))

    def apply(
        self, spark: SparkSession, day: Day, changed: Callable[[DataFrame | None], DataFrame]
    ) -> DataFrame:
        """Adds the rows that ``changed`` makes of the current ones, unless the day was
        applied before; returns them."""
        known = self.of_day(spark, day)
        if known is not None:
            return known
        self._fold(spark)
        state = self.read(spark)
        rows = changed(state if state is None else state.drop(APPLIED_ON)).withColumn(APPLIED_ON, F.lit(day))
        folder = self._folder(_BASE if state is None else _CHANGES, day)
        rows.write.mode("overwrite").parquet(folder)
        return spark.read.parquet(folder)

    def _fold(self, spark: SparkSession) -> None:
        """Writes a new base if there are enough changes, and drops what is before the last one."""
        base = self._base_day(spark)
        if base is None:
            return
        folders = self._changes_since(spark, base)
        size = sum(paths.size(spark, f) for f in folders)
        if not folders or (
            len(folders) < self.fold_days
            and size < self.fold_share * paths.size(spark, self._folder(_BASE, base))
        ):
            return
        last = self._days(spark, _CHANGES)[-1]
        self.read(spark).write.mode("overwrite").parquet(self._folder(_BASE, last))
        # The base before and the changes since then stay for those that still read them.
        for kind in (_BASE, _CHANGES):
            for day in self._days(spark, kind):
                if day < base or (kind == _CHANGES and day == base):
                    paths.remove(spark, self._folder(kind, day))
