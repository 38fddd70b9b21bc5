"""History from a stream of changes.

Every microbatch is a snapshot run over the keys it changes: it closes their open
versions and opens new ones. Open versions are a keyed table, so a batch reads and writes
those of its keys; closed versions are written once, in a folder of the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.intervals import last_per_group
from tidemark.operators.snapshots import snapshot_run
from tidemark.schemas import VALID_TO, open_end
from tidemark.session import working_folder
from tidemark.sources import paths
from tidemark.sources.keyed import APPLIED_ON, KeyedTable


@dataclass(frozen=True)
class StreamedHistory:
    """Where a history is kept, its key, and the columns that put changes in order."""

    path: str
    key: str
    updated_at: str
    tiebreak: str

    @property
    def opened(self) -> KeyedTable:
        return KeyedTable(f"{self.path}/open", self.key)

    def _closed(self, number: int) -> str:
        return f"{self.path}/closed/batch-{number}"

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All versions; None before the first batch. Closed ones count with their batch."""
        found = self.opened.read(spark)
        if found is None:
            return None
        found = found.drop(APPLIED_ON)
        last = self.opened.last(spark)
        numbers = [int(n.rpartition("-")[2]) for n in paths.names(spark, f"{self.path}/closed")]
        folders = [self._closed(n) for n in sorted(numbers) if n <= last]
        return found.unionByName(spark.read.schema(found.schema).parquet(*folders)) if folders else found

    def apply(self, batch: DataFrame, number: int) -> None:
        """Close and open what the batch changes; a batch that comes again does nothing.

        Broken off before the open versions are written, the batch counts for nothing and
        does all of it again.
        """
        spark = batch.sparkSession
        if self.opened.of_day(spark, number) is not None:
            return
        newest = last_per_group(batch, [self.key], [self.updated_at, self.tiebreak])
        state = self.opened.read(spark)
        if state is not None:
            # Only versions of the batch's keys take part.
            state = state.drop(APPLIED_ON).join(batch.select(self.key), self.key, "left_semi")
            state = state.select(*[c for c in self.opened.read(spark).columns if c != APPLIED_ON])
        folder = working_folder(spark)
        try:
            versions = snapshot_run(state, newest, self.key, self.updated_at)
            versions.write.parquet(folder)
            versions = spark.read.schema(versions.schema).parquet(folder)
            is_open = F.col(VALID_TO) == open_end()
            versions.where(~is_open).write.mode("overwrite").parquet(self._closed(number))
            self.opened.apply(spark, number, lambda _: versions.where(is_open))
        finally:
            paths.remove(spark, folder)


def keep_streamed_history(changes: DataFrame, history: StreamedHistory) -> DataStreamWriter:
    """A stream of changes into a history, a snapshot run per microbatch.

    Of several changes of a key in one batch the last counts, as in a run that sees the
    state in between never.
    """
    return changes.writeStream.foreachBatch(history.apply)
