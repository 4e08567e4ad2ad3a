"""Keyed dedupe: the newest row of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import require_columns


def latest_per_key(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """One row per key, the one with the highest sequence; null is lowest, null keys are one key.

    Ties go to the greatest remaining columns, in their order, nulls last. Spark turns the filter on the rank into a group limit before the shuffle, so a hot key sends one
    row per task.
    """
    require_columns(df, [*keys, sequence], "latest_per_key")
    orderable = lambda t: not isinstance(t, (T.MapType, T.VariantType))
    rest = [f.name for f in df.schema if f.name not in (*keys, sequence) and orderable(f.dataType)]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (sequence, *rest)]
    w = Window.partitionBy(*(F.col(f"`{k}`") for k in keys)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def dedupe_key(df: DataFrame, configured: list[str]) -> list[str]:
    return configured or [c for c in df.columns if not c.startswith("_")]


def dedupe_sequence(incremental_column: str | None) -> str:
    return incremental_column or "_ingested_at"
