"""Random samples of live rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.attributes import sampling_order


def random_live_rows(
    table: DataFrame, key: str, n: int, seed: int, created_before: Column | None = None
) -> DataFrame:
    """``n`` random rows that are not soft-deleted, optionally created before a time.

    Planned as a top-n: each task keeps n rows, there is no full sort.
    """
    live = table.where(F.col("deleted_at").isNull())
    if created_before is not None:
        live = live.where(F.col("created_at") < created_before)
    return live.orderBy(sampling_order(F.col(key), seed), key).limit(n)
