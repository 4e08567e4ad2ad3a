"""Type 2 history of a keyed table by one full outer join of the incoming rows with the open versions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import row_hash

HISTORY = ["valid_from", "valid_to", "is_current", "is_deleted", "_row_hash"]
PROVENANCE = {"ingested_at", "run_id", "source", "_ingested_at", "_run_id", "_source"}
STEP = timedelta(microseconds=1)


@dataclass(frozen=True)
class Outcome:
    opened: int = 0
    closed: int = 0
    tombstoned: int = 0
    unchanged: int = 0
    late_skipped: int = 0

    @property
    def changed(self) -> bool:
        return self.opened > 0


def hashed_columns(df: DataFrame, keys: list[str]) -> list[str]:
    return sorted(c for c in df.columns if c not in keys and c not in PROVENANCE and c not in HISTORY)


def effective_time(df: DataFrame, incremental: str | None, run_time: Column) -> Column:
    """The row's own time where the incremental column is one, else the run's."""
    if incremental in df.columns and isinstance(df.schema[incremental].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.col(incremental).cast("timestamp"), run_time)
    return run_time


def with_history(df: DataFrame, keys: list[str], effective: Column) -> DataFrame:
    return df.withColumns({"_row_hash": row_hash(df, hashed_columns(df, keys)), "valid_from": effective}).withColumns(
        {"valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True), "is_deleted": F.lit(False)}
    )


def guard_schema(history: DataFrame, incoming: DataFrame) -> None:
    business = lambda d: {c for c in d.columns if c not in HISTORY and c not in PROVENANCE}
    added, removed = sorted(business(incoming) - business(history)), sorted(business(history) - business(incoming))
    if added or removed:
        raise ValueError(f"history and batch differ: added {added}, removed {removed}")


def classified(history: DataFrame, incoming: DataFrame, keys: list[str], effective: Column, run_time: Column, tombstones: bool) -> DataFrame:
    """Each key of the batch or of an open version once: structs ``old`` and ``new``, the ``action`` and the ``start`` of a version it opens.

    Actions: open (new key), unchanged, reopen (after a deletion), late (not after the open version began), change, tombstone (absent), keep.
    """
    new = with_history(incoming, keys, effective)
    old = history.filter("is_current")
    as_struct = lambda d, name: d.select(*(F.col(f"`{k}`").alias(f"__{name}_{i}") for i, k in enumerate(keys)), F.struct(*(F.col(f"`{c}`") for c in d.columns)).alias(name))
    on = None
    for i in range(len(keys)):
        same = F.col(f"__old_{i}").eqNullSafe(F.col(f"__new_{i}"))
        on = same if on is None else on & same
    both = as_struct(old, "old").join(as_struct(new, "new"), on, "full_outer")
    absent = F.when(F.lit(tombstones) & ~F.col("old.is_deleted"), "tombstone").otherwise("keep")
    action = (
        F.when(F.col("new").isNull(), absent)
        .when(F.col("old").isNull(), "open")
        .when((F.col("new._row_hash") == F.col("old._row_hash")) & ~F.col("old.is_deleted"), "unchanged")
        .when(F.col("old.is_deleted"), "reopen")
        .when(F.col("new.valid_from") <= F.col("old.valid_from"), "late")
        .otherwise("change")
    )
    start = (
        F.when(action == "reopen", F.greatest(F.col("new.valid_from"), F.col("old.valid_from") + F.lit(STEP)))
        .when(action == "tombstone", F.greatest(run_time, F.col("old.valid_from") + F.lit(STEP)))
        .otherwise(F.col("new.valid_from"))
    )
    return both.withColumn("action", action).withColumn("start", start).select("old", "new", "action", "start")


def after_batch(columns: list[str], marked: DataFrame) -> DataFrame:
    """What becomes of the open versions: kept or closed, and the new ones."""
    opens = F.col("action").isin("open", "reopen", "change", "tombstone")
    closes = F.col("action").isin("reopen", "change", "tombstone")

    def field(c: str, version: Column, opened: bool) -> Column:
        own = {"valid_from": F.col("start"), "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True), "is_deleted": F.col("action") == "tombstone"} if opened else {"valid_to": F.when(closes, F.col("start")).otherwise(F.col("old.valid_to")), "is_current": ~closes}
        return own.get(c, version.getField(c)).alias(c)

    new_fields = set(marked.schema["new"].dataType.names)
    source = lambda c: F.when(F.col("action") == "tombstone", F.col("old").getField(c)).otherwise(F.col("new").getField(c) if c in new_fields else F.lit(None))
    opened_row = F.struct(*(field(c, F.col("old"), True) if c in ("valid_from", "valid_to", "is_current", "is_deleted") else source(c).alias(c) for c in columns))
    kept_row = F.struct(*(field(c, F.col("old"), False) for c in columns))
    rows = F.array_compact(F.array(F.when(F.col("old").isNotNull(), kept_row), F.when(opens, opened_row)))
    return marked.select(F.explode(rows).alias("r")).select("r.*").select(*columns)


def rewritten(history: DataFrame, marked: DataFrame) -> DataFrame:
    """The history after the batch: past versions, open ones kept or closed, and new ones."""
    return history.filter("not is_current").unionByName(after_batch(history.columns, marked))


def outcome(marked: DataFrame) -> Outcome:
    n = {r.action: r["count"] for r in marked.groupBy("action").count().collect()}
    closed = sum(n.get(a, 0) for a in ("reopen", "change", "tombstone"))
    return Outcome(n.get("open", 0) + closed, closed, n.get("tombstone", 0), n.get("unchanged", 0), n.get("late", 0))
