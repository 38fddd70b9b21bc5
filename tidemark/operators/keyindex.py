"""Which days the keys of a table may be on, as a few sorted-out runs of files.

Every load adds a run: its keys with their days, in as many buckets (by a hash of the
key) as its rows need. Runs of like size are folded into one, so that there are at most
FOLD of each size, whatever the number of loads, and an entry is written again once per
size it grows through. A lookup reads, of each run, the buckets its keys fall into; in a
run of one bucket that is all of it.

An entry says that a key may be on a day. A key that left the day stays noted for it, which
costs a look at that day and nothing else.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import paths

# Rows of one bucket, which is one file.
BUCKET_ROWS = 2_000_000
# So many runs of like size become one.
FOLD = 8
_BUCKET = "_bucket"


@dataclass(frozen=True)
class Run:
    """One set of files: its number, rows and buckets are in the name of its folder."""

    number: int
    rows: int
    buckets: int

    @property
    def name(self) -> str:
        return f"run-{self.number}-{self.rows}-{self.buckets}"

    @classmethod
    def of(cls, name: str) -> Run:
        return cls(*map(int, name.split("-")[1:]))

    @property
    def size(self) -> int:
        """Runs of one size differ by less than the factor FOLD."""
        return int(math.log(max(self.rows, 1), FOLD))


@dataclass(frozen=True)
class KeyIndex:
    path: str
    keys: tuple[str, ...]
    day: str

    def runs(self, spark: SparkSession) -> list[Run]:
        """The completely written runs, oldest first."""
        found = [Run.of(n) for n in paths.names(spark, self.path) if n.startswith("run-")]
        whole = [r for r in found if paths.exists(spark, f"{self.path}/{r.name}/_SUCCESS")]
        return sorted(whole, key=lambda r: r.number)

    def add(self, rows: DataFrame, count: int) -> None:
        """Note the days of these rows' keys; ``count`` is their number."""
        spark = rows.sparkSession
        known = self.runs(spark)
        number = 1 + max((r.number for r in known), default=-1)
        run = Run(number, count, max(1, math.ceil(count / BUCKET_ROWS)))
        self._write(rows.select(*self.keys, self.day), run)
        self._fold(spark, [*known, run])

    def _fold(self, spark: SparkSession, known: list[Run]) -> None:
        sizes = defaultdict(list)
        for run in known:
            sizes[run.size].append(run)
        full = [runs for runs in sizes.values() if len(runs) >= FOLD]
        if not full:
            return
        old = full[0]
        rows = sum(r.rows for r in old)
        run = Run(known[-1].number + 1, rows, max(1, math.ceil(rows / BUCKET_ROWS)))
        folders = [f for r in old for f in self._folders(spark, r, None)]
        schema = spark.read.parquet(folders[0]).schema
        self._write(spark.read.schema(schema).parquet(*folders), run)
        # Broken off here, some entries are there twice.
        for done in old:
            paths.remove(spark, f"{self.path}/{done.name}")
        self._fold(spark, [r for r in [*known, run] if r not in old])

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _write(self, entries: DataFrame, run: Run) -> None:
        path = f"{self.path}/{run.name}"
        if run.buckets == 1:
            entries.coalesce(1).write.mode("overwrite").parquet(path)
            return
        dealt = entries.withColumn(_BUCKET, self._bucket(run.buckets)).repartition(_BUCKET)
        # Without another shuffle: equal entries are in one bucket.
        once = dealt.dropDuplicates([_BUCKET, *self.keys, self.day])
        once.write.mode("overwrite").partitionBy(_BUCKET).parquet(path)

    def _folders(self, spark: SparkSession, run: Run, touched: set[int] | None) -> list[str]:
        path = f"{self.path}/{run.name}"
        if run.buckets == 1:
            return [path]
        present = [n for n in paths.names(spark, path) if n.startswith(f"{_BUCKET}=")]
        if touched is not None:
            present = [n for n in present if int(n.partition("=")[2]) in touched]
        return [f"{path}/{name}" for name in present]

    def entries(self, keys: DataFrame, count: int) -> DataFrame | None:
        """(keys, day) of the buckets these keys fall into; None without an index.

        ``count`` is the number of keys: many reach every bucket, and are not asked.
        """
        spark = keys.sparkSession
        runs = self.runs(spark)
        if not runs:
            return None
        touched: dict[int, set[int] | None] = {}
        for buckets in {r.buckets for r in runs} - {1}:
            if count < 4 * buckets:
                # At most as many numbers as keys.
                numbers = keys.select(self._bucket(buckets)).distinct().collect()
                touched[buckets] = {row[0] for row in numbers}
        folders = [f for r in runs for f in self._folders(spark, r, touched.get(r.buckets))]
        kinds = {**{f.name: f.dataType.simpleString() for f in keys.schema}, self.day: "date"}
        schema = ", ".join(f"`{name}` {kinds[name]}" for name in (*self.keys, self.day))
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)

    def days_of(self, keys: DataFrame, count: int) -> set[dt.date | None] | None:
        """The days these keys may be on; None without an index."""
        noted = self.entries(keys, count)
        if noted is None:
            return None
        found = noted.join(keys, list(self.keys), "left_semi").select(self.day).distinct()
        # At most one row per calendar day.
        return {row[0] for row in found.collect()}
