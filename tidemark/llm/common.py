"""What several operators share: stored intermediate tables and slices of Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import working_folder

# Bytes of text that a task works on at once, whatever the size of an Arrow batch.
SLICE_BYTES = 8_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage, so that what is used twice is computed once, and a lost
    executor costs a task of the reading job and not the whole computation.
    """
    path = f"{working_folder(df.sparkSession)}/{name}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column; NULL is the empty text."""
    return batch.column(name).cast(pa.large_string()).fill_null("")


def slices(batch: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of ``name`` each; one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(name)).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)
        # Workers live on; what a slice took is not theirs to keep.
        pa.default_memory_pool().release_unused()


def crc32(ids: np.ndarray) -> int:
    """Checksum of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def unused(columns: list[str], name: str) -> str:
    """A column name like ``name`` that is not among the columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_kind(vocabulary_size: int) -> str:
    """Numpy type that holds every id of a vocabulary, little-endian."""
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def sums_before(df: DataFrame, order: str, value: str, name: str, group: int = 4096) -> DataFrame:
    """Adds the sum of ``value`` over all rows with a smaller ``order`` (unique, from 0, dense or not).

    In two levels, so that no window holds more than ``group`` rows or one row a group.
    """
    level = F.floor(F.col(order) / group)
    within = Window.partitionBy("_level").orderBy(order)
    marked = df.withColumn("_level", level)
    totals = marked.groupBy("_level").agg(F.sum(value).alias("_total"))
    over = Window.orderBy("_level").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_level", F.coalesce(F.sum("_total").over(over), F.lit(0)).alias("_start"))
    own = F.sum(value).over(within) - F.col(value)
    return (
        marked.withColumn("_own", own)
        .join(starts, "_level")
        .withColumn(name, (F.col("_own") + F.col("_start")).cast("bigint"))
        .drop("_level", "_own", "_start")
    )


# The archive of each application; kept as long as executors may ask for it.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


# Bytes of an Arrow batch, of which a task holds several copies.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "16m"


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, for those that were not started with it, and
    bounds Arrow batches by their bytes unless the session does so already."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH_BYTES[0], None) is None:
        spark.conf.set(*_BATCH_BYTES)
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    _SHIPPED[context.applicationId] = folder = tempfile.TemporaryDirectory()
    archive = f"{folder.name}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
