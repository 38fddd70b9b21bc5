"""Folders and small files on whatever file system a path belongs to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

# Fixed value: the folder Spark writes rows with a NULL partition column to.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _folder(spark, path)
    return files.exists(location)


def is_file(spark: SparkSession, path: str) -> bool:
    files, location = _folder(spark, path)
    return files.exists(location) and files.getFileStatus(location).isFile()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, location = _folder(spark, path)
    return files.getContentSummary(location).getLength()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder; none if it does not exist."""
    files, location = _folder(spark, path)
    if not files.exists(location):
        return []
    return [status.getPath().getName() for status in files.listStatus(location)]


def day_folder(column: str, day: dt.date | None) -> str:
    """Folder name of one day of a date-partitioned table; rows without a day have one too."""
    return f"{column}={_NO_VALUE if day is None else day.isoformat()}"


def partition_days(spark: SparkSession, path: str, column: str) -> list[dt.date | None]:
    """The days a date-partitioned table has folders for, newest first, None last."""
    prefix = f"{column}="
    values = [n[len(prefix) :] for n in names(spark, path) if n.startswith(prefix)]
    days = sorted((dt.date.fromisoformat(v) for v in values if v != _NO_VALUE), reverse=True)
    return days + [None] if _NO_VALUE in values else days


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    files, location = _folder(spark, path)
    _, draft = _folder(spark, f"{path}.draft")
    out = files.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files.delete(location, False)
    if not files.rename(draft, location):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    files, location = _folder(spark, path)
    source = files.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it exists."""
    files, location = _folder(spark, path)
    files.delete(location, True)
