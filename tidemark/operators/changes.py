"""Applying a batch of changes to raw state, with an audit of what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of a change batch besides key and attributes. ``set_columns`` names the
# attributes an update sets, so that setting one to NULL differs from leaving it.
CHANGE_TYPE = "change_type"
CHANGED_AT = "changed_at"
SET_COLUMNS = "set_columns"
# Optional: decides between changes at the same time, the highest one counts.
CHANGE_ID = "change_id"
CREATED_AT = "created_at"
APPLIED = "applied"


def _net_changes(changes: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row per key: its delete, its insert, and the last value set per attribute.

    Everything is aggregated, so a key with very many changes is combined in the
    tasks that read them.
    """
    kind, at = F.col(CHANGE_TYPE), F.col(CHANGED_AT)
    is_update, is_insert = kind == "update", kind == "insert"
    # Without a change id, or for equal ones, the values decide: the outcome never
    # depends on the order rows are read in.
    ids = [CHANGE_ID] if CHANGE_ID in changes.columns else []

    def last_set(name: str) -> Column:
        applies = is_update & F.array_contains(SET_COLUMNS, name)
        return F.max_by(
            F.struct(F.col(name).alias("value")), F.when(applies, F.struct(at, *ids, name))
        )

    return changes.groupBy(F.col(key).alias("_key")).agg(
        F.max(F.when(kind == "delete", at)).alias("_deleted_at"),
        F.max(F.when(is_update, at)).alias("_updated_at"),
        F.max_by(
            F.struct(F.col(CREATED_AT), at.alias("updated_at"), *attributes),
            F.when(is_insert, F.struct(at, *ids, CREATED_AT, *attributes)),
        ).alias("_insert"),
        *[last_set(name).alias(f"_set_{name}") for name in attributes],
    )


def merge_changes(
    state: DataFrame, changes: DataFrame, key: str, attributes: list[str]
) -> DataFrame:
    """The new state plus ``applied``: inserted, updated, deleted or NULL.

    Deletes come before updates and these before inserts. Deletes and updates touch
    live rows only; an insert whose key exists already is not applied, so a batch
    may be run again. A delete is soft: it sets ``deleted_at`` and ``updated_at``.
    """
    net = _net_changes(changes, key, attributes)
    both = state.withColumn("_exists", F.lit(True)).join(
        net, F.col(key) == F.col("_key"), "full_outer"
    )
    exists = F.col("_exists").isNotNull()
    live = exists & F.col("deleted_at").isNull()
    deleted = live & F.col("_deleted_at").isNotNull()
    updated = live & ~deleted & F.col("_updated_at").isNotNull()
    inserted = ~exists & F.col("_insert").isNotNull()

    values = {
        key: F.coalesce(F.col(key), F.col("_key")),
        "created_at": F.when(inserted, F.col("_insert.created_at")).otherwise(F.col("created_at")),
        "updated_at": F.when(inserted, F.col("_insert.updated_at"))
        .when(deleted, F.col("_deleted_at"))
        .when(updated, F.col("_updated_at"))
        .otherwise(F.col("updated_at")),
        "deleted_at": F.when(deleted, F.col("_deleted_at")).otherwise(F.col("deleted_at")),
    }
    for name in attributes:
        was_set = updated & F.col(f"_set_{name}").isNotNull()
        values[name] = (
            F.when(inserted, F.col(f"_insert.{name}"))
            .when(was_set, F.col(f"_set_{name}.value"))
            .otherwise(F.col(name))
        )
    applied = (
        F.when(inserted, "inserted").when(deleted, "deleted").when(updated, "updated")
    )
    return both.where(exists | inserted).select(
        *[values.get(name, F.col(name)).alias(name) for name in state.columns],
        applied.alias(APPLIED),
    )


def changed_rows(
    state: DataFrame, changes: DataFrame, key: str, attributes: list[str]
) -> DataFrame:
    """The rows a batch inserts, updates or deletes, as they are then, with ``applied``.

    Only the batch's keys are looked for in the state; no other row takes part.
    """
    touched = state.join(changes.select(key), key, "left_semi").select(state.columns)
    return merge_changes(touched, changes, key, attributes).where(F.col(APPLIED).isNotNull())


def apply_changes(
    state: DataFrame, changes: DataFrame, key: str, attributes: list[str]
) -> DataFrame:
    return merge_changes(state, changes, key, attributes).drop(APPLIED)


def audit_row(merged: DataFrame, table_name: str, ingest_date: Column, now: Column) -> DataFrame:
    """One audit row with the rows really inserted, updated and deleted."""

    def rows(kind: str) -> Column:
        return F.count_if(F.col(APPLIED) == kind).alias(f"rows_{kind}")

    return merged.agg(rows("inserted"), rows("updated"), rows("deleted")).select(
        ingest_date.alias("ingest_date"),
        F.lit(table_name).alias("table_name"),
        "rows_inserted",
        "rows_updated",
        "rows_deleted",
        now.cast("timestamp_ntz").alias("real_timestamp"),
    )


def live_row_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, total, live, deleted)``; a table without soft deletes is all live."""
    parts = None
    for name, df in tables.items():
        gone = F.col("deleted_at").isNotNull() if "deleted_at" in df.columns else F.lit(False)
        counted = df.agg(F.count("*").alias("total"), F.count_if(gone).alias("deleted")).select(
            F.lit(name).alias("table_name"),
            "total",
            (F.col("total") - F.col("deleted")).alias("live"),
            "deleted",
        )
        parts = counted if parts is None else parts.unionByName(counted)
    return parts


def next_job_date(audit: DataFrame, first: Column) -> DataFrame:
    """The day after the last one ingested, or ``first`` when there is none."""
    last = audit.agg(F.max("ingest_date").alias("last"))
    return last.select(F.coalesce(F.date_add("last", 1), first).alias("job_date"))
