"""Small tables written as tuples, times as text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F


def table(spark, columns: str, *rows):
    """``columns`` as ``name type``; text is cast, so times can be written as text."""
    names = [part.split()[0] for part in columns.split(",")]
    kinds = [part.split()[1] for part in columns.split(",")]
    text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    raw = spark.createDataFrame(text, ", ".join(f"{n} string" for n in names))
    return raw.select(*[F.col(n).cast(k).alias(n) for n, k in zip(names, kinds)])


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)
