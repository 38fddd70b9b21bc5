"""Small notes beside a table: numbered files that are added, merged on read and dropped.

A note is never overwritten. It appears under its name once it is complete, so a run that
breaks off leaves the notes before it as they were.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tidemark.sources import paths

_SUFFIX = ".json"


def read(spark: SparkSession, folder: str) -> dict[int, object]:
    """All notes by their number."""
    found = [n for n in paths.names(spark, folder) if n.endswith(_SUFFIX)]
    return {
        int(name.removesuffix(_SUFFIX)): json.loads(paths.read_text(spark, f"{folder}/{name}"))
        for name in sorted(found)
    }


def add(spark: SparkSession, folder: str, content: object) -> None:
    names = [n for n in paths.names(spark, folder) if n.endswith(_SUFFIX)]
    number = 1 + max((int(n.removesuffix(_SUFFIX)) for n in names), default=0)
    paths.write_text(spark, f"{folder}/{number:08d}{_SUFFIX}", json.dumps(content))


def drop(spark: SparkSession, folder: str, numbers) -> None:
    for number in numbers:
        paths.remove(spark, f"{folder}/{number:08d}{_SUFFIX}")
