"""Star schema: dimensions with surrogate keys and an unknown member, facts with looked-up keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import surrogate_key
from tidemark.functions.names import snake_case

UNKNOWN = 0


@dataclass(frozen=True)
class Reference:
    """``column`` of a fact points at the one-column natural key of ``dimension``, whose silver rows are ``rows``."""

    column: str
    dimension: str
    rows: DataFrame
    natural_key: list[str]
    history: bool = False


def key_column(object_name: str) -> str:
    return f"{snake_case(object_name)}_key"


def keyed(rows: DataFrame, natural_key: list[str], history: bool) -> DataFrame:
    return rows.withColumn("__key", surrogate_key(rows, [*natural_key, *(["valid_from"] if history else [])]))


def dimension(rows: DataFrame, object_name: str, natural_key: list[str], history: bool = False) -> DataFrame:
    """Every silver row with its key, and the unknown member: key 0, all else null."""
    name = key_column(object_name)
    body = keyed(rows, natural_key, history).withColumnRenamed("__key", name).select(name, *(F.col(f"`{c}`") for c in rows.columns))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in body.schema])
    unknown = rows.sparkSession.createDataFrame([(UNKNOWN, *[None] * len(rows.columns))], schema)
    return body.unionByName(unknown)


def current_keys(ref: Reference) -> DataFrame:
    """natural key -> surrogate of the row that holds now; deleted versions don't count."""
    live = keyed(ref.rows, ref.natural_key, ref.history)
    if ref.history:
        live = live.filter("is_current and not is_deleted")
    return live.select(F.col(f"`{ref.natural_key[0]}`").alias("__nk"), "__key").dropDuplicates(["__nk"])


def key_intervals(ref: Reference) -> DataFrame:
    """natural key -> surrogates with [from, until), and whether it is the one that holds now; a deletion doesn't end the version before it."""
    live = keyed(ref.rows, ref.natural_key, True).filter("not is_deleted")
    w, newest = Window.partitionBy("__nk").orderBy("__from"), Window.partitionBy("__nk").orderBy(F.desc("is_current"), F.desc("__from"), "__key")
    spans = live.select(F.col(f"`{ref.natural_key[0]}`").alias("__nk"), "__key", F.col("valid_from").alias("__from"), "is_current")
    return spans.withColumns({"__until": F.lead("__from").over(w), "__now": F.col("is_current") & (F.row_number().over(newest) == 1)}).drop("is_current")


class KeyCollision(RuntimeError):
    """Two members of a dimension have one surrogate key."""


def check_keys(dim: DataFrame, name: str) -> None:
    """Raises KeyCollision if a surrogate key isn't unique: by chance in one of some 10^9 members' 2^63 keys, or by a natural key that repeats."""
    twice = dim.groupBy(name).agg(F.count("*").alias("n")).filter("n > 1").limit(5).collect()
    if twice:
        raise KeyCollision(f"{name} {', '.join(str(r[0]) for r in twice)} has several members")


def look_up(fact: DataFrame, ref: Reference, event_time: str | None, out: str) -> DataFrame:
    """``fact`` with ``out``, the key of its member: of the version that held at ``event_time``, or of the current one; 0 if there is none.

    The dimension is broadcast where Spark finds it small; else both sides are shuffled by the natural key and AQE splits hot keys.
    """
    if len(ref.natural_key) != 1:
        raise ValueError(f"{ref.dimension}: a reference needs a key of one column, not {', '.join(ref.natural_key)}")
    column = F.col(f"`{ref.column}`")
    if not (ref.history and event_time):
        found = fact.join(current_keys(ref), column == F.col("__nk"), "left")
        return found.withColumn(out, F.coalesce("__key", F.lit(UNKNOWN))).drop("__nk", "__key")
    t = F.col(f"`{event_time}`").cast("timestamp")
    held = (t >= F.col("__from")) & (F.col("__until").isNull() | (t < F.col("__until")))
    # without an event time the current version holds
    found = fact.join(key_intervals(ref), (column == F.col("__nk")) & (held | (t.isNull() & F.col("__now"))), "left")
    return found.withColumn(out, F.coalesce("__key", F.lit(UNKNOWN))).drop("__nk", "__key", "__from", "__until", "__now")


def out_names(refs: list[Reference]) -> list[str]:
    """The key column of each reference; with the fact's column in front where a dimension is referenced twice."""
    many = {r.dimension for r in refs if sum(x.dimension == r.dimension for x in refs) > 1}
    return [f"{r.column}_{key_column(r.dimension)}" if r.dimension in many else key_column(r.dimension) for r in refs]


def fact(rows: DataFrame, refs: list[Reference], event_time: str | None = None) -> tuple[DataFrame, list[str]]:
    """The fact with a key in place of each natural key, and the names of the keys."""
    names = out_names(refs)
    for r, out in zip(refs, names, strict=True):
        rows = look_up(rows, r, event_time, out)
    return rows.drop(*(r.column for r in refs)), names


def unresolved(rows: DataFrame, names: list[str]) -> dict[str, int]:
    """How many rows have the unknown member, by key, in one aggregate."""
    if not names:
        return {}
    return rows.agg(*(F.count_if(F.col(n) == UNKNOWN).alias(n) for n in names)).first().asDict()
