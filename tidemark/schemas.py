"""Schemas of the raw tables and the names of the history columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _TIME = T.StringType(), T.TimestampNTZType()

USER = _schema(
    user_id=_TEXT,
    first_name=_TEXT,
    last_name=_TEXT,
    created_at=_TIME,
    updated_at=_TIME,
    deleted_at=_TIME,
    country_code=_TEXT,
    favorite_color=_TEXT,
)
POST = _schema(
    post_id=_TEXT,
    user_id=_TEXT,
    post_text=_TEXT,
    created_at=_TIME,
    updated_at=_TIME,
    deleted_at=_TIME,
)
EVENT = _schema(
    event_id=_TEXT,
    user_id=_TEXT,
    post_id=_TEXT,
    created_at=_TIME,
    event_type=_TEXT,
)
AUDIT = _schema(
    ingest_date=T.DateType(),
    table_name=_TEXT,
    rows_inserted=T.LongType(),
    rows_updated=T.LongType(),
    rows_deleted=T.LongType(),
    real_timestamp=_TIME,
)
COUNTRY = _schema(
    country_code=_TEXT, name=_TEXT, currency=_TEXT, region=_TEXT, subregion=_TEXT
)
RAW = {"user": USER, "post": POST, "event": EVENT}

# The open end of a version, the default for missing cohort
# attributes, and the column names of a version history.
OPEN_END = "9999-12-31 00:00:00"
UNKNOWN = "Unknown"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
UPDATED_AT = "dbt_updated_at"
SCD_ID = "dbt_scd_id"
IS_DELETED = "dbt_is_deleted"


def timestamp(text: str) -> Column:
    """A timestamp without time zone."""
    return F.lit(text).cast("timestamp_ntz")


def open_end() -> Column:
    return timestamp(OPEN_END)
