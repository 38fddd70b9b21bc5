"""Slowly changing dimension history, kept run by run (type 2, timestamp strategy)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.attributes import version_id
from tidemark.schemas import (
    IS_DELETED,
    SCD_ID,
    UPDATED_AT,
    VALID_FROM,
    VALID_TO,
    open_end,
)

_IGNORE, _RECORD = "ignore", "new_record"


def _version(
    attributes: list[Column],
    key: Column,
    changed_at: Column,
    opens: Column,
    deleted: str | None,
) -> Column:
    columns = [
        *attributes,
        version_id(key, changed_at).alias(SCD_ID),
        changed_at.alias(UPDATED_AT),
        opens.alias(VALID_FROM),
        open_end().alias(VALID_TO),
    ]
    if deleted is not None:
        columns.append(F.lit(deleted).alias(IS_DELETED))
    return F.struct(*columns)


def _first_opens(changed_at: Column, initial: Column | None) -> Column:
    """Where a key's first version begins: never after its first change."""
    return changed_at if initial is None else F.least(changed_at, initial)


def first_snapshot(
    source: DataFrame,
    key: str,
    updated_at: str,
    hard_deletes: str = _IGNORE,
    initial_valid_from: str | None = None,
) -> DataFrame:
    """One open version per source row, valid from ``updated_at``.

    ``initial_valid_from`` names another column to open first versions with, such
    as the creation time, so that events before the first update find a version.
    """
    changed_at = F.col(updated_at)
    opens = _first_opens(changed_at, initial_valid_from and F.col(initial_valid_from))
    attributes = [F.col(name) for name in source.columns]
    flag = "False" if hard_deletes == _RECORD else None
    return source.select(
        F.inline(F.array(_version(attributes, F.col(key), changed_at, opens, flag)))
    )


def history_schema(source: DataFrame, record: bool = False) -> T.StructType:
    """The columns of the history of ``source``, with or without deletion records."""
    text, time = T.StringType(), T.TimestampNTZType()
    names = {SCD_ID: text, UPDATED_AT: time, VALID_FROM: time, VALID_TO: time}
    if record:
        names[IS_DELETED] = text
    return T.StructType([*source.schema.fields, *(T.StructField(n, k) for n, k in names.items())])


def snapshot_run(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str,
    run_ts: Column | None = None,
    hard_deletes: str = _IGNORE,
    initial_valid_from: str | None = None,
) -> DataFrame:
    """The history after one more run over the source as it is now.

    A key whose ``updated_at`` is later than the start of its open version gets a
    new version, and the old one ends there. A change that leaves ``updated_at``
    alone opens nothing. A key that is gone keeps its open version, or, with
    ``hard_deletes='new_record'``, has it closed at ``run_ts`` by a deletion record
    that repeats the last attributes; when the key comes back, a normal version
    follows that record, beginning at ``updated_at`` or, if that lies before the
    deletion, at ``run_ts``, so versions never overlap.

    Closed versions are passed on without a shuffle; a history that is stored run by
    run hands in its open versions only. Open versions and source hold one row per key
    each and meet in a single full outer join.
    """
    if hard_deletes not in (_IGNORE, _RECORD):
        raise ValueError(f"unknown hard_deletes: {hard_deletes}")
    record = hard_deletes == _RECORD
    if record and run_ts is None:
        raise ValueError("deletion records need run_ts, the time of the run")
    if history is None:
        return first_snapshot(source, key, updated_at, hard_deletes, initial_valid_from)

    is_open = F.col(VALID_TO) == open_end()
    closed = history.where(~is_open)
    old = history.where(is_open).select(F.struct(*history.columns).alias("old"))
    new = source.select(F.struct(*source.columns).alias("new"))
    both = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    changed_at = F.col(f"new.{updated_at}")
    is_new, is_gone = F.col("old").isNull(), F.col("new").isNull()
    was_deleted = F.col(f"old.{IS_DELETED}").eqNullSafe("True") if record else F.lit(False)
    is_back = ~is_new & ~is_gone & was_deleted
    # A first version may begin before its change, and one after a deletion later, at
    # the run that saw it; neither is a reason to open another.
    last_seen = F.greatest(f"old.{UPDATED_AT}", f"old.{VALID_FROM}")
    is_changed = ~is_new & ~is_gone & ~was_deleted & (changed_at > last_seen)
    goes = is_gone & ~was_deleted if record else F.lit(False)

    from_source = [F.col(f"new.{name}").alias(name) for name in source.columns]
    from_old = [F.col(f"old.{name}").alias(name) for name in source.columns]
    flag = "False" if record else None
    new_key, old_key = F.col(f"new.{key}"), F.col(f"old.{key}")
    first_opens = _first_opens(
        changed_at, initial_valid_from and F.col(f"new.{initial_valid_from}")
    )
    opens = F.when(is_new, first_opens).otherwise(changed_at)
    if record:
        late = is_back & (changed_at <= F.col(f"old.{VALID_FROM}"))
        opens = F.when(late, run_ts).otherwise(opens)
    opened = F.when(
        is_new | is_changed | is_back,
        _version(from_source, new_key, changed_at, opens, flag),
    )

    ends = F.when(is_changed | is_back, opens)
    if record:
        ends = F.when(goes, run_ts).otherwise(ends)
    names = [*source.columns, SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]
    names += [IS_DELETED] if record else []
    kept_values = {name: F.col(f"old.{name}") for name in names}
    kept_values[VALID_TO] = F.coalesce(ends, kept_values[VALID_TO])
    kept = F.when(
        ~is_new, F.struct(*[value.alias(name) for name, value in kept_values.items()])
    )
    versions = [kept, opened]
    if record:
        versions.append(F.when(goes, _version(from_old, old_key, run_ts, run_ts, "True")))
    return closed.unionByName(both.select(F.inline(F.array_compact(F.array(*versions)))))
