"""Readers and writers of the raw tables, the country lookup and built tables."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sources import paths

_VERSION = "v="
_OPEN = "_open"
# Rows of one bucket of a bucketed table.
BUCKET_ROWS = 4_000_000


def read_raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Raw ``user``, ``post`` or ``event`` table with its declared schema."""
    return spark.read.schema(schemas.RAW[table]).parquet(f"{folder}/{table}")


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """Country lookup from a CSV with header.

    Blank fields are NULL, the code ``NA`` stays text, spaces are kept.
    """
    return spark.read.schema(schemas.COUNTRY).option("header", True).csv(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write the partitions ``df`` has rows for and leave all others alone."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def _versions(spark: SparkSession, path: str) -> list[int]:
    numbers = [int(n[len(_VERSION) :]) for n in paths.names(spark, path) if n.startswith(_VERSION)]
    return sorted(numbers)


def current_version(spark: SparkSession, path: str) -> int | None:
    """The newest completely written version of a table."""
    for number in reversed(_versions(spark, path)):
        if paths.exists(spark, f"{path}/{_VERSION}{number}/_SUCCESS"):
            return number
    return None


def version_folder(path: str, number: int) -> str:
    return f"{path}/{_VERSION}{number}"


def next_version(spark: SparkSession, path: str) -> int:
    current = current_version(spark, path)
    return 0 if current is None else current + 1


def write_table(df: DataFrame, path: str) -> None:
    """Replace a whole table that ``df`` itself may read.

    Writes the next version beside the current one. A version counts once its
    success marker exists, so readers see the old table until the new one is
    complete, and a run that broke off is simply repeated.
    """
    number = next_version(df.sparkSession, path)
    df.write.mode("overwrite").parquet(version_folder(path, number))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The current version of a table, None if there is none yet.

    With the schema given, no file has to be opened for planning.
    """
    number = current_version(spark, path)
    if number is None:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/{_VERSION}{number}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` completed versions, and what broke off before."""
    completed = [
        number
        for number in _versions(spark, path)
        if paths.exists(spark, f"{path}/{_VERSION}{number}/_SUCCESS")
    ]
    if not completed:
        return
    oldest = completed[-keep:][0]
    for number in _versions(spark, path):
        if number < oldest:
            paths.remove(spark, f"{path}/{_VERSION}{number}")


def write_history(versions: DataFrame, path: str) -> None:
    """What a snapshot run changes: the versions it closed, and all that are open now.

    Each run is a version of the table with both in folders of their own. Versions
    closed by earlier runs are not written again; open ones are current in the newest
    run only. A run counts once its success marker exists, so both change together.
    """
    number = next_version(versions.sparkSession, path)
    is_open = F.col(schemas.VALID_TO) == schemas.open_end()
    (
        versions.withColumn(_OPEN, is_open)
        .write.mode("overwrite")
        .partitionBy(_OPEN)
        .parquet(version_folder(path, number))
    )


def _history_parts(spark: SparkSession, path: str, numbers: list[int], is_open: str) -> list[str]:
    folders = [f"{path}/{_VERSION}{n}/{_OPEN}={is_open}" for n in numbers]
    return [f for f in folders if paths.exists(spark, f)]


def read_history(
    spark: SparkSession, path: str, schema: T.StructType, only_open: bool = False
) -> DataFrame | None:
    """All versions of a history, or the open ones; None before the first run."""
    current = current_version(spark, path)
    if current is None:
        return None
    folders = _history_parts(spark, path, [current], "true")
    if not only_open:
        # One folder a run.
        runs = [n for n in _versions(spark, path) if n <= current]
        folders += _history_parts(spark, path, runs, "false")
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def drop_old_open_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete the open versions of all but the newest ``keep`` runs; closed ones stay."""
    current = current_version(spark, path)
    if current is not None:
        old = [n for n in _versions(spark, path) if n <= current - keep]
        for folder in _history_parts(spark, path, old, "true"):
            paths.remove(spark, folder)


def bucket_count(rows: int) -> int:
    """Buckets for a table of so many rows: a power of two, so that tables of different
    sizes have buckets that fit into one another."""
    return 1 << max(3, math.ceil(math.log2(max(1, rows / BUCKET_ROWS))))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """The rows stored by a hash of the key. Joins and aggregations on the key of tables with
    as many buckets read them as they are, without a shuffle."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    # The rows of a bucket are brought together first, so that a bucket is one file.
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def publish_view(df: DataFrame, name: str) -> None:
    """A view: nothing is stored, the plan is inlined where it is used."""
    df.createOrReplaceTempView(name)
