"""Derived attributes of users, posts, events and versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import UNKNOWN


def full_name(first: str, last: str) -> Column:
    """NULL when either part is NULL, hence ``concat`` and not ``concat_ws``."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN)).alias(name)


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def is_like(event_type: str = "event_type") -> Column:
    """1 for a like; 0 for everything else, NULL included."""
    return F.when(F.col(event_type) == "like", 1).otherwise(0)


def ratio(part: str, whole: str) -> Column:
    """NULL where there is nothing to divide by."""
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def version_id(key: Column, changed_at: Column) -> Column:
    """Identifier of one version: hash of its key and the time it was opened."""
    return F.md5(F.concat_ws("|", key.cast("string"), changed_at.cast("string")))


def sampling_order(key: Column, seed: int) -> Column:
    """Pseudo-random order by a seeded hash.

    Unlike ``rand`` it does not depend on how rows are laid out, so a task that
    is run again after a lost executor picks the same rows.
    """
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
