"""Bronze to silver: dedupe, conform, rules, masks, quarantine, then a snapshot or history."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.control.store import SourceObject
from tidemark.functions.names import layer_path, snake_case
from tidemark.operators import scd2
from tidemark.operators.conform import conform
from tidemark.operators.dedupe import dedupe_key, dedupe_sequence, latest_per_key
from tidemark.operators.privacy import apply_masks, masking_key
from tidemark.operators.quality import QualityFailure, Rule, evaluate
from tidemark.plans.bronze import Lake
from tidemark.storage.keyed import KeyedTable


@dataclass(frozen=True)
class SilverResult:
    version: int
    rows_read: int
    rows_written: int
    duplicates: int
    quarantined: int
    history: scd2.Outcome | None = None


def rules_of(lake: Lake, obj: SourceObject) -> list[Rule]:
    return [Rule(r["id"], r["rule_type"], r["severity"], r["column_name"], r["expression"]) for r in lake.store.rows("SELECT * FROM dq_rule WHERE source_object_id = ? AND active = 1 ORDER BY id", obj.id)]


def write_quarantine(lake: Lake, obj: SourceObject, rejected: DataFrame, n: int, run_id: str, task_id: int, at: datetime) -> int | None:
    """Appends rejected rows, merging schemas; with none there is no table."""
    if not n:
        return None
    path = layer_path(obj.target_path, "quarantine")
    kept = [c for c in rejected.columns if c not in ("_run_id",)]
    out = rejected.select(*kept).withColumns({"_quarantined_at": F.lit(at), "_run_id": F.lit(run_id), "_task_run_id": F.lit(task_id), "_rejected_from": F.lit(obj.target_path)})
    return lake.table(path).append(out, merge_schema=True)


def build(lake: Lake, obj: SourceObject, run_id: str, at: datetime | None = None) -> SilverResult:
    """One lazy plan from bronze to masked rows; its deduplicated form is persisted once, as the rule aggregate and the writes all read it."""
    at = at or datetime.now(UTC)
    with lake.work(run_id, obj, "silver", lake.own(obj.target_path), layer_path(obj.target_path, "silver")) as task:
        bronze = lake.table(obj.target_path).read()
        seen = Observation()
        counted = bronze.observe(seen, F.count(F.lit(1)).alias("n"))
        deduped = conform(latest_per_key(counted, dedupe_key(bronze, obj.keys), dedupe_sequence(obj.incremental_column))).persist()
        try:
            rules = rules_of(lake, obj)
            try:
                report = evaluate(deduped, rules, at.timestamp())
            except QualityFailure as e:
                lake.store.record_results(task["id"], e.report.results)
                raise
            lake.store.record_results(task["id"], report.results)
            n_read = seen.get["n"]
            strategies = {c: p["masking_strategy"] for c, p in lake.store.policies(obj).items()}
            key = masking_key(_secret(lake, obj), lake.environment) if any(s in ("hash", "partial") for s in strategies.values()) else b""
            kept, _ = apply_masks(report.accepted, strategies, key)
            bad, _ = apply_masks(report.rejected, strategies, key)
            write_quarantine(lake, obj, bad, report.rejected_rows, run_id, task["id"], at)
            duplicates = n_read - report.rows
            table = lake.table(layer_path(obj.target_path, "silver"))
            history = None
            if obj.scd2_enabled:
                version, history = write_history(lake, obj, kept, report.rows - report.rejected_rows, at)
                written, rejected = history.opened, duplicates + report.rejected_rows + history.late_skipped
            else:
                version = table.overwrite(kept)
                written = report.rows - report.rejected_rows
                rejected = duplicates + report.rejected_rows
            task.update(status="quarantined" if report.rejected_rows else "succeeded", rows_read=n_read, rows_written=written, rows_rejected=rejected)
            task["lineage"] = (kept, {snake_case(c): [c] for c in bronze.columns})
            return SilverResult(version, n_read, written, duplicates, report.rejected_rows, history)
        finally:
            deduped.unpersist()


def _secret(lake: Lake, obj: SourceObject) -> str | None:
    return lake.store.one("SELECT secret_name FROM source_system WHERE id = ?", obj.source_system_id)["secret_name"]


def write_history(lake: Lake, obj: SourceObject, rows: DataFrame, n: int, at: datetime) -> tuple[int, scd2.Outcome]:
    """The first batch opens a version of each of its ``n`` rows; later ones are merged, and commit nothing if nothing changed.

    Open versions lie in key buckets, of which a batch rewrites those it touches (all, where absence means deletion); closed versions are appended and never written again.
    """
    keys = [snake_case(k) for k in obj.keys]
    table = KeyedTable(lake.table(layer_path(obj.target_path, "silver")), keys)
    run_time = F.lit(at)
    incremental = snake_case(obj.incremental_column) if obj.incremental_column else None
    effective = scd2.effective_time(rows, incremental, run_time)
    if not table.table.exists():
        return table.create(scd2.with_history(rows, keys, effective), n, "scd2"), scd2.Outcome(opened=n)
    old = table.table.manifest()
    scd2.guard_schema(lake.spark.createDataFrame([], old.struct), rows)
    tombstones = obj.load_strategy in ("full", "cdc")
    found: dict = {}

    def merged(stored: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        marked = found["marked"] = scd2.classified(stored, rows, keys, effective, run_time, tombstones).persist()
        found["outcome"] = scd2.outcome(marked)
        if not found["outcome"].changed:
            return None
        after = scd2.after_batch(stored.columns, marked)
        past = after.filter("not is_current")
        if table.layout(old) is None:  # a table without buckets: its closed versions move once
            past = stored.filter("not is_current").unionByName(past)
        return after.filter("is_current"), past

    try:
        version = table.merge(None if tombstones else rows, merged, old.struct, "scd2", lambda: {"opened": found["outcome"].opened, "closed": found["outcome"].closed})
        return version, found["outcome"]
    finally:
        if "marked" in found:
            found["marked"].unpersist()
