"""Shape conformance: names, white space and epoch times, in one projection."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import snake_columns
from tidemark.functions.text import strip

TIME_SUFFIXES = ("_at", "_date", "_time")
_UNITS = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}


def epoch_columns(df: DataFrame) -> list[str]:
    """Integer columns whose name says they hold a time."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType) and f.name.endswith(TIME_SUFFIXES)]


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*(strip(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema))


def epoch_to_timestamp(df: DataFrame, names: Collection[str], unit: str = "s") -> DataFrame:
    """Integer columns among ``names`` as timestamps; others are left alone."""
    wanted = {f.name for f in df.schema if f.name in names and isinstance(f.dataType, T.IntegralType)}
    return df.withColumns({n: _UNITS[unit](F.col(n).cast("bigint")) for n in wanted})


def conform(df: DataFrame) -> DataFrame:
    named = snake_columns(df)
    return epoch_to_timestamp(trim_strings(named), epoch_columns(named))


def drop_restricted(df: DataFrame, policies: dict[str, tuple[str, bool]], keep: Collection[str] = ()) -> DataFrame:
    """Without columns classified ``sensitive_pii`` that aren't allowed in gold. policies: column -> (sensitivity, allowed)."""
    return df.drop(*(c for c, (s, ok) in policies.items() if s == "sensitive_pii" and not ok and c not in keep))
