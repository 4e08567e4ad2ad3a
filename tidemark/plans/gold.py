"""Silver to gold: dimensions, and facts with surrogate keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.control.store import SourceObject
from tidemark.functions.names import gold_path, layer_path, snake_case
from tidemark.operators import star
from tidemark.operators.conform import drop_restricted
from tidemark.plans.bronze import Lake


@dataclass(frozen=True)
class GoldResult:
    version: int
    rows_read: int
    rows_written: int
    unresolved: dict[str, int] = field(default_factory=dict)


def _policies(lake: Lake, obj: SourceObject) -> dict[str, tuple[str, bool]]:
    return {snake_case(c): (p["sensitivity"], bool(p["allow_in_gold"])) for c, p in lake.store.policies(obj).items()}


def _silver(lake: Lake, obj: SourceObject):
    return lake.table(layer_path(obj.target_path, "silver")).read()


def _work(lake: Lake, obj: SourceObject, run_id: str, role: str):
    return lake.work(run_id, obj, "gold", lake.own(layer_path(obj.target_path, "silver")), gold_path(obj.object_name, role))


def build_dimension(lake: Lake, obj: SourceObject, run_id: str) -> GoldResult:
    with _work(lake, obj, run_id, "dimension") as task:
        keys = [snake_case(k) for k in obj.keys]
        rows = drop_restricted(_silver(lake, obj), _policies(lake, obj), keys)
        out = star.dimension(rows, obj.object_name, keys, obj.scd2_enabled)
        path = gold_path(obj.object_name, "dimension")
        seen = Observation()
        version = lake.table(path).overwrite(out.observe(seen, F.count(F.lit(1)).alias("n")))
        n = seen.get["n"] - 1
        star.check_keys(lake.table(path).read(version), star.key_column(obj.object_name))
        task.update(rows_read=n, rows_written=n + 1, lineage=(out, {star.key_column(obj.object_name): keys, **{c: [c] for c in rows.columns}}))
        return GoldResult(version, n, n + 1)


def event_time(lake: Lake, obj: SourceObject) -> str | None:
    """The conformed incremental column, if it is a time."""
    column = snake_case(obj.incremental_column) if obj.incremental_column else None
    schema = _silver(lake, obj).schema
    return column if column in schema.names and isinstance(schema[column].dataType, (T.TimestampType, T.TimestampNTZType)) else None


def references(lake: Lake, obj: SourceObject) -> list[star.Reference]:
    found = lake.store.rows("SELECT * FROM gold_reference WHERE fact_object_id = ? ORDER BY id", obj.id)
    out = []
    for r in found:
        d = lake.store.object(r["dimension_object_id"])
        out.append(star.Reference(snake_case(r["fact_column"]), d.object_name, _silver(lake, d), [snake_case(k) for k in d.keys], d.scd2_enabled))
    return out


def build_fact(lake: Lake, obj: SourceObject, run_id: str) -> GoldResult:
    with _work(lake, obj, run_id, "fact") as task:
        refs = references(lake, obj)
        rows = _silver(lake, obj)
        out, names = star.fact(rows, refs, event_time(lake, obj))
        out = drop_restricted(out, _policies(lake, obj), names)
        table = lake.table(gold_path(obj.object_name, "fact"))
        seen = Observation()
        version = table.overwrite(out.observe(seen, F.count(F.lit(1)).alias("_n"), *(F.count_if(F.col(c) == star.UNKNOWN).alias(c) for c in names)))
        missing = dict(seen.get)
        n = missing.pop("_n")
        task.update(rows_read=n, rows_written=n, rows_rejected=sum(missing.values()), lineage=(out, {**{k: [r.column] for k, r in zip(names, refs, strict=True)}, **{c: [c] for c in out.columns if c not in names}}))
        return GoldResult(version, n, n, missing)


def build(lake: Lake, obj: SourceObject, run_id: str) -> GoldResult:
    if obj.gold_role == "dimension":
        return build_dimension(lake, obj, run_id)
    if obj.gold_role == "fact":
        return build_fact(lake, obj, run_id)
    raise ValueError(f"{obj.object_name} has no role in gold")
