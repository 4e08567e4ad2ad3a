"""Change batches by key against a stored table, with separate clauses for deletes, updates and inserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import require_columns
from tidemark.operators.dedupe import latest_per_key


def collapse(changes: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    require_columns(changes, [*keys, sequence], "change batch")
    return latest_per_key(changes, keys, sequence)


def is_delete(changes: DataFrame, operation: str | None, delete_value: str) -> Column:
    """A null operation, or none at all, is an upsert."""
    if operation is None:
        return F.lit(False)
    require_columns(changes, [operation], "change batch")
    return F.coalesce(F.col(operation) == F.lit(delete_value), F.lit(False))


def split(changes: DataFrame, operation: str | None, delete_value: str) -> tuple[DataFrame, DataFrame]:
    gone = is_delete(changes, operation, delete_value)
    return changes.filter(~gone), changes.filter(gone)


def merged(target: DataFrame, changes: DataFrame, keys: list[str], operation: str | None, delete_value: str) -> DataFrame:
    """target rows after a collapsed batch with the column ``__action``: keep, update, insert, delete or ignore. Rows of the last two have no place in the new table.

    One full outer join on null-safe keys. Columns that only one side has are null on the other.
    """
    t = target.select(F.struct(*(F.col(f"`{c}`") for c in target.columns)).alias("t"))
    s = changes.withColumn("__gone", is_delete(changes, operation, delete_value)).select(F.struct(*(F.col(f"`{c}`") for c in changes.columns)).alias("s"), "__gone")
    on = F.lit(True)
    for k in keys:
        on = on & F.col("t").getField(k).eqNullSafe(F.col("s").getField(k))
    action = (
        F.when(F.col("s").isNull(), "keep")
        .when(F.col("t").isNull(), F.when(F.col("__gone"), "ignore").otherwise("insert"))
        .otherwise(F.when(F.col("__gone"), "delete").otherwise("update"))
    )
    both = t.join(s, on, "full_outer").withColumn("__action", action)
    columns = [*target.columns, *(c for c in changes.columns if c not in target.columns)]

    def value(c: str) -> Column:
        old = F.col("t").getField(c) if c in target.columns else F.lit(None)
        new = F.col("s").getField(c) if c in changes.columns else F.lit(None)
        return F.when(F.col("s").isNull(), old).otherwise(new).alias(c)

    return both.select("__action", *(value(c) for c in columns))
