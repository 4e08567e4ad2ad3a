"""Runs of the layers over all active objects, by configuration."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from tidemark.control.store import ControlStore, SourceObject
from tidemark.plans import bronze, gold, silver
from tidemark.plans.bronze import Lake
from tidemark.sources.source import Source


@dataclass(frozen=True)
class Step:
    object_name: str
    layer: str
    status: str
    rows: int = 0
    error: str | None = None


@dataclass
class RunReport:
    run_id: str
    steps: list[Step] = field(default_factory=list)

    @property
    def failures(self) -> int:
        return sum(s.status == "failed" for s in self.steps)

    def __str__(self) -> str:
        lines = [f"{s.layer:<7}{s.object_name:<24}{s.status:<12}{s.rows:>12}{'  ' + s.error if s.error else ''}" for s in self.steps]
        return "\n".join([*lines, f"{len(self.steps)} steps, {self.failures} failed, {sum(s.rows for s in self.steps)} rows"])


def _done(store: ControlStore, run_id: str, layer: str) -> set[int]:
    return {r["source_object_id"] for r in store.rows("SELECT source_object_id FROM task_run WHERE run_id = ? AND layer = ? AND status IN ('succeeded', 'quarantined')", run_id, layer)}


def run_layer(lake: Lake, run_id: str, layer: str, work: Callable[[SourceObject], int], objects: Iterable[SourceObject], stop_on_error: bool = False) -> list[Step]:
    """One object's failure doesn't stop the others; objects that this run has done before are skipped, so a run can be resumed by its id."""
    steps, done = [], _done(lake.store, run_id, layer)
    for obj in objects:
        if obj.id in done:
            steps.append(Step(obj.object_name, layer, "skipped"))
            continue
        try:
            rows = work(obj)
            status = lake.store.one("SELECT status FROM task_run WHERE run_id = ? AND source_object_id = ? AND layer = ? ORDER BY id DESC", run_id, obj.id, layer)
            steps.append(Step(obj.object_name, layer, status["status"] if status else "succeeded", rows))
        except Exception as e:  # noqa: BLE001 - recorded in the task and the report
            steps.append(Step(obj.object_name, layer, "failed", error=f"{type(e).__name__}: {e}"))
            if stop_on_error:
                break
    return steps


def chosen(store: ControlStore, names: Iterable[str] | None) -> list[SourceObject]:
    wanted = None if names is None else set(names)
    return [o for o in store.objects() if wanted is None or o.object_name in wanted]


def run_bronze(lake: Lake, source: Source, names: Iterable[str] | None = None, run_id: str | None = None, stop_on_error: bool = False) -> RunReport:
    with lake.store.run("bronze", run_id=run_id) as rid:
        return RunReport(rid, run_layer(lake, rid, "bronze", lambda o: bronze.load(lake, source, o, rid).rows_written, chosen(lake.store, names), stop_on_error))


def run_pipeline(lake: Lake, source: Source, names: Iterable[str] | None = None, run_id: str | None = None, stop_on_error: bool = False) -> RunReport:
    """All three layers; dimensions before facts."""
    with lake.store.run("pipeline", run_id=run_id) as rid:
        report = RunReport(rid)
        objects = chosen(lake.store, names)
        modelled = sorted((o for o in objects if o.gold_role), key=lambda o: o.gold_role != "dimension")
        for layer, work, todo in (
            ("bronze", lambda o: bronze.load(lake, source, o, rid).rows_written, objects),
            ("silver", lambda o: silver.build(lake, o, rid).rows_written, objects),
            ("gold", lambda o: gold.build(lake, o, rid).rows_written, modelled),
        ):
            failed = {s.object_name for s in report.steps if s.status == "failed"}
            report.steps += run_layer(lake, rid, layer, work, [o for o in todo if o.object_name not in failed], stop_on_error)
            if stop_on_error and report.failures:
                break
        return report


def asset_graph(store: ControlStore) -> dict[str, set[str]]:
    """asset -> assets it waits for; a fact waits for its dimensions too."""
    graph: dict[str, set[str]] = {}
    by_id = {o.id: o for o in store.objects()}
    for o in by_id.values():
        graph[f"bronze.{o.object_name}"] = set()
        graph[f"silver.{o.object_name}"] = {f"bronze.{o.object_name}"}
        if o.gold_role:
            graph[f"gold.{o.object_name}"] = {f"silver.{o.object_name}"}
    for r in store.rows("SELECT * FROM gold_reference"):
        if r["fact_object_id"] in by_id and r["dimension_object_id"] in by_id:
            graph[f"gold.{by_id[r['fact_object_id']].object_name}"].add(f"gold.{by_id[r['dimension_object_id']].object_name}")
    return graph


def asset_order(store: ControlStore) -> list[str]:
    return list(TopologicalSorter(asset_graph(store)).static_order())


@dataclass(frozen=True)
class CatalogEntry:
    object_name: str
    load_strategy: str
    primary_key_columns: str
    gold_role: str | None = None
    incremental_column: str | None = None
    scd2_enabled: bool = False
    references: tuple[tuple[str, str], ...] = ()
    load_order: int = 100


#: The seeded shop.
SHOP = (
    CatalogEntry("customers", "full", "customer_id", "dimension", "updated_at", True, load_order=10),
    CatalogEntry("products", "full", "product_id", "dimension", "updated_at", load_order=10),
    CatalogEntry("sellers", "full", "seller_id", "dimension", "updated_at", load_order=10),
    CatalogEntry("orders", "incremental", "order_id", "fact", "updated_at", references=(("customer_id", "customers"),)),
    CatalogEntry("order_items", "incremental", "order_item_id", "fact", "updated_at", references=(("product_id", "products"), ("seller_id", "sellers"))),
)


def register(store: ControlStore, system: str, entries: Iterable[CatalogEntry], schema: str = "public") -> dict[str, int]:
    """Makes system, objects and references what the catalog says; running it again changes nothing."""
    entries = list(entries)
    store.upsert("source_system", {"name": system}, kind="file")
    sid = store.one("SELECT id FROM source_system WHERE name = ?", system)["id"]
    ids = {}
    for e in entries:
        key = {"source_system_id": sid, "schema_name": schema, "object_name": e.object_name}
        store.upsert("source_object", key, target_path=f"bronze/{e.object_name}", load_strategy=e.load_strategy, incremental_column=e.incremental_column, primary_key_columns=e.primary_key_columns, gold_role=e.gold_role, scd2_enabled=int(e.scd2_enabled), load_order=e.load_order)
        ids[e.object_name] = store.one("SELECT id FROM source_object WHERE source_system_id = ? AND schema_name = ? AND object_name = ?", *key.values())["id"]
    for e in entries:
        for column, dim in e.references:
            store.upsert("gold_reference", {"fact_object_id": ids[e.object_name], "fact_column": column}, dimension_object_id=ids[dim])
    return ids
