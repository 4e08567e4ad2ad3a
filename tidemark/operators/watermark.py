"""High watermarks of incremental loads: types, text form, grace and the window they open."""

from __future__ import annotations

import logging
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import require_columns

log = logging.getLogger(__name__)
Watermark = datetime | int | str


def kind_of(df: DataFrame, column: str) -> str:
    require_columns(df, [column], "watermark")
    t = df.schema[column].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "timestamp"
    return "integer" if isinstance(t, T.IntegralType) else "string"


def encode(value: Watermark) -> str:
    if isinstance(value, date) and not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if isinstance(value, datetime):
        return (value if value.tzinfo else value.replace(tzinfo=UTC)).isoformat()
    return str(value)


def decode(text: str | None, kind: str) -> Watermark | None:
    if text is None:
        return None
    if kind == "timestamp":
        at = datetime.fromisoformat(text)
        return at if at.tzinfo else at.replace(tzinfo=UTC)
    return int(text) if kind == "integer" else text


def with_grace(value: Watermark | None, grace: int | None, kind: str) -> Watermark | None:
    """Grace is seconds of a timestamp and units of an integer; texts have none."""
    if value is None or not grace or grace <= 0:
        return value
    if kind == "string":
        log.warning("a text watermark has no grace window")
        return value
    return value - timedelta(seconds=grace) if kind == "timestamp" else value - grace


def newer_than(df: DataFrame, column: str, since: Watermark | None) -> DataFrame:
    """Rows strictly above the mark; the comparison reaches a Parquet scan. Nulls are left out once there is a mark."""
    require_columns(df, [column], "incremental read")
    return df if since is None else df.filter(F.col(f"`{column}`") > F.lit(since))
