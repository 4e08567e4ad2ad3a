"""Loads into bronze: full, incremental and change feed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.control import drift
from tidemark.control.store import ControlStore, SourceObject, now
from tidemark.operators import cdc
from tidemark.operators.watermark import Watermark, decode, encode, kind_of, newer_than, with_grace
from tidemark.plans.lineage import Lineage
from tidemark.sources.source import Source
from tidemark.storage.keyed import KeyedTable
from tidemark.storage.table import VersionedTable


@dataclass(frozen=True)
class LoadResult:
    version: int
    rows_read: int
    rows_written: int
    rows_rejected: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0


@dataclass(frozen=True)
class IncrementalLoad(LoadResult):
    watermark_from: str | None = None
    watermark_to: str | None = None
    rows_reprocessed: int = 0


@dataclass
class Lake:
    spark: SparkSession
    root: str
    store: ControlStore
    lineage: Lineage | None = None
    environment: str = "development"

    def table(self, path: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root.rstrip('/')}/{path}")

    @contextmanager
    def work(self, run_id: str, obj: SourceObject, layer: str, source: tuple[str, str], target: str) -> Iterator[dict]:
        """A task row with its lineage events: START before the body, then COMPLETE with what the body put under ``lineage`` (a frame and its columns' origins), or FAIL."""
        with self.store.task(run_id, obj, layer) as task:
            event = self.lineage.start(run_id, f"{layer}.{obj.object_name}", [source], target) if self.lineage else None
            try:
                yield task
            except Exception as e:
                if event:
                    self.lineage.fail(event, e)
                raise
            if event:
                self.lineage.complete(event, *task.get("lineage", ()))

    def own(self, path: str) -> tuple[str, str]:
        return (self.lineage.namespace if self.lineage else "", path)


def stamped(df: DataFrame, obj: SourceObject, run_id: str, at: datetime | None = None) -> DataFrame:
    """With where from and when: one fixed time per load."""
    at = at or datetime.now(UTC)
    return df.withColumns({"_ingested_at": F.lit(at), "_run_id": F.lit(run_id), "_source": F.lit(obj.object_name)})


def row_count(df: DataFrame) -> int:
    return df.count()


def latest_run_id(df: DataFrame) -> str | None:
    return df.agg(F.max("_run_id")).first()[0]


def _need(obj: SourceObject, strategy: str) -> None:
    if obj.load_strategy != strategy:
        raise ValueError(f"{obj.object_name} is loaded by {obj.load_strategy}, not {strategy}")


def _work(lake: Lake, obj: SourceObject, run_id: str):
    system = lake.store.one("SELECT name FROM source_system WHERE id = ?", obj.source_system_id)["name"]
    return lake.work(run_id, obj, "bronze", (f"source://{system}", f"{obj.schema_name}.{obj.object_name}"), obj.target_path)


def _same(df: DataFrame) -> tuple[DataFrame, dict[str, list[str]]]:
    return df, {c: [c] for c in df.columns}


def full_load(lake: Lake, source: Source, obj: SourceObject, run_id: str) -> LoadResult:
    _need(obj, "full")
    with _work(lake, obj, run_id) as task:
        df = source.read(obj)
        drift.check(lake.store, obj, df)
        seen = Observation()
        version = lake.table(obj.target_path).overwrite(stamped(df, obj, run_id).observe(seen, F.count(F.lit(1)).alias("n")))
        n = seen.get["n"]
        drift.record(lake.store, obj, drift.describe(df))
        task.update(rows_read=n, rows_written=n, lineage=_same(df))
        return LoadResult(version, n, n)


def incremental_load(lake: Lake, source: Source, obj: SourceObject, run_id: str) -> IncrementalLoad:
    """Rows above the watermark less its grace are appended; the watermark moves only after the commit, and only up.

    The source is read once: rows are counted and the new watermark is found while they are written, so that both are of the rows written.
    """
    _need(obj, "incremental")
    column, table = obj.incremental_column, lake.table(obj.target_path)
    with _work(lake, obj, run_id) as task:
        mark = lake.store.one("SELECT * FROM load_watermark WHERE source_object_id = ?", obj.id)
        since = decode(mark["watermark_value"], mark["watermark_type"]) if mark else None
        everything = source.read(obj)
        kind = kind_of(everything, column)
        edge = with_grace(since, obj.watermark_grace, kind)
        df = source.read_since(obj, edge) if hasattr(source, "read_since") else newer_than(everything, column, edge)
        drift.check(lake.store, obj, df)
        seen = Observation()
        again = F.count_if(F.col(column) <= F.lit(since)) if since is not None else F.count_if(F.lit(False))
        out = stamped(df, obj, run_id).observe(seen, F.count(F.lit(1)).alias("n"), F.max(column).alias("top"), again.alias("again"))
        files = table.stage(out)
        got = seen.get
        version = table.version()
        if got["n"]:
            version = table.append(out, merge_schema=True, files=files)
            drift.record(lake.store, obj, drift.describe(df))
        top = _higher(since, got["top"], kind)
        if got["n"] and top is not None and top != since:
            lake.store.upsert("load_watermark", {"source_object_id": obj.id}, watermark_value=encode(top), watermark_type=kind, committed_run_id=run_id, updated_at=now())
        before, after = (encode(x) if x is not None else None for x in (since, top))
        task.update(rows_read=got["n"], rows_written=got["n"], watermark_from=before, watermark_to=after, lineage=_same(df))
        return IncrementalLoad(version, got["n"], got["n"], watermark_from=before, watermark_to=after, rows_reprocessed=got["again"])


def _higher(since: Watermark | None, top, kind: str) -> Watermark | None:
    if top is None:
        return since
    top = decode(encode(top), kind)
    return top if since is None or top > since else since


def cdc_load(lake: Lake, source: Source, obj: SourceObject, run_id: str) -> LoadResult:
    """The newest change of each key, merged into the key buckets it touches; the first batch only keeps what isn't deleted."""
    _need(obj, "cdc")
    table = KeyedTable(lake.table(obj.target_path), obj.keys)
    with _work(lake, obj, run_id) as task:
        raw = source.read(obj)
        drift.check(lake.store, obj, raw)
        read = Observation()
        batch = cdc.collapse(raw.observe(read, F.count(F.lit(1)).alias("n")), obj.keys, obj.incremental_column or obj.keys[0])
        changes = stamped(batch, obj, run_id).persist()
        counts: dict = {}
        try:
            n_keys = changes.count()
            n_raw = read.get["n"]
            if not table.table.exists():
                upserts, _ = cdc.split(changes, obj.cdc_operation_column, obj.cdc_delete_value)
                counts = {"insert": upserts.count()}
                version = table.create(upserts, counts["insert"], "cdc", counts)
            elif not n_keys:
                version = table.table.version()
            else:
                merge = lambda old: cdc.merged(old, changes, obj.keys, obj.cdc_operation_column, obj.cdc_delete_value)

                def replaced(old: DataFrame) -> tuple[DataFrame, None]:
                    replaced.seen = Observation()
                    actions = [F.count_if(F.col("__action") == a).alias(a) for a in ("insert", "update", "delete")]
                    return merge(old).observe(replaced.seen, *actions).filter(~F.col("__action").isin("delete", "ignore")).drop("__action"), None

                version = table.merge(changes, replaced, merge(table.table.read()).drop("__action").schema, "merge", lambda: replaced.seen.get)
                counts = replaced.seen.get
        finally:
            changes.unpersist()
        drift.record(lake.store, obj, drift.describe(raw))
        inserted, updated, deleted = (counts.get(a, 0) for a in ("insert", "update", "delete"))
        task.update(rows_read=n_raw, rows_written=inserted + updated + deleted, rows_rejected=n_raw - n_keys, lineage=_same(raw))
        return LoadResult(version, n_raw, inserted + updated + deleted, n_raw - n_keys, inserted, updated, deleted)


LOADERS = {"full": full_load, "incremental": incremental_load, "cdc": cdc_load}


def load(lake: Lake, source: Source, obj: SourceObject, run_id: str) -> LoadResult:
    return LOADERS[obj.load_strategy](lake, source, obj, run_id)
