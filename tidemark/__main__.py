"""Command line: ``python -m tidemark COMMAND``."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from tidemark.control import contracts
from tidemark.control.store import DIALECTS, ControlStore, ddl
from tidemark.operators.privacy import scan
from tidemark.plans import audit, replay, runner
from tidemark.plans.bronze import Lake
from tidemark.plans.classify import apply_proposals
from tidemark.plans.lineage import Lineage
from tidemark.runtime import build_session
from tidemark.settings import Settings, configure_logging
from tidemark.sources.seed import Seed
from tidemark.sources.source import ParquetSource
from tidemark.storage import maintenance
from tidemark.storage.table import VersionedTable


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("tidemark")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="command", required=True)
    for name, args in {
        "pipeline": [("--source", {"required": True}), ("--register", {"action": "store_true"}), ("--object", {"action": "append"}), ("--run-id", {}), ("--stop-on-error", {"action": "store_true"})],
        "seed": [("root", {}), ("--rows", {"type": int, "default": 10_000}), ("--seed", {"type": int, "default": 42})],
        "privacy": [("--source", {"required": True}), ("--apply", {"action": "store_true"})],
        "audit": [("--close-abandoned", {"action": "store_true"}), ("--html", {"action": "store_true"})],
        "maintenance": [("action", {"choices": ["stats", "compact", "zorder", "vacuum"]}), ("table", {}), ("--columns", {"default": ""}), ("--run", {"action": "store_true"}), ("--hours", {"type": float, "default": maintenance.RETENTION_HOURS})],
        "replay": [("action", {"choices": ["history", "restore", "rewind"]}), ("target", {}), ("--at", {}), ("--run", {"action": "store_true"})],
        "contracts": [("path", {}), ("--sync", {"action": "store_true"})],
        "migrate": [("--check", {"action": "store_true"}), ("--ddl", {"nargs": "?", "const": "sqlite", "choices": list(DIALECTS)})],
    }.items():
        cmd = sub.add_parser(name)
        for flag, options in args:
            cmd.add_argument(flag, **options)
    return p


def main(argv: list[str] | None = None) -> int:
    """0: all well; 1: something failed; 2: wrong usage."""
    a = parser().parse_args(argv)
    settings = Settings.load()
    configure_logging(settings.log_level)
    store = ControlStore(settings.control_path)
    if a.command == "migrate":
        print(ddl(a.ddl) if a.ddl else f"versions {'missing' if a.check else 'applied'}: {store.migrate(a.check)}")
        return int(a.check and bool(store.migrate(check=True)))
    store.migrate()
    if a.command == "contracts":
        found = contracts.load(a.path)
        for c in found:
            print(f"{c.source_system}.{c.object}: {contracts.sync(store, c) if a.sync else len(c.rules())} rules")
        return 0
    spark = build_session(master=a.master)
    lake = Lake(spark, settings.lake_root, store, Lineage(settings.lineage_path) if settings.lineage_path else None, settings.environment)
    if a.command == "seed":
        Seed(spark, a.rows, a.seed).write(a.root)
    elif a.command == "pipeline":
        if a.register:
            runner.register(store, "shop", runner.SHOP)
        report = runner.run_pipeline(lake, ParquetSource(spark, a.source), a.object, a.run_id, a.stop_on_error)
        print(report)
        return int(report.failures > 0)
    elif a.command == "privacy":
        for obj in store.objects():
            found = scan(ParquetSource(spark, a.source).read(obj))
            for p in found:
                print(f"{obj.object_name}.{p.column}: {p.sensitivity}, {p.masking} ({p.evidence})")
            if a.apply:
                apply_proposals(store, obj, found)
    elif a.command == "audit":
        if a.close_abandoned:
            print(audit.close_abandoned(spark, store, dry_run=False))
        views = audit.Audit(audit.frames(spark, store))
        print((audit.html_report if a.html else audit.report)(views, datetime.now(UTC)))
    elif a.command == "maintenance":
        t = VersionedTable(spark, f"{settings.lake_root}/{a.table}")
        actions = {"stats": lambda: maintenance.file_stats(t), "compact": lambda: maintenance.compact(t), "zorder": lambda: maintenance.zorder(t, a.columns.split(",")), "vacuum": lambda: maintenance.vacuum(t, a.hours, dry_run=not a.run)}
        print(actions[a.action]())
    elif a.action == "rewind":
        obj = next(o for o in store.objects() if o.object_name == a.target)
        print(replay.rewind(store, obj, replay.parse_moment(a.at), dry_run=not a.run))
    else:
        t = VersionedTable(spark, f"{settings.lake_root}/{a.target}")
        if a.action == "history":
            for m in t.history():
                print(m.version, datetime.fromtimestamp(m.ts, UTC).isoformat(), m.operation, len(m.files), m.metrics)
        else:
            print(t.restore(t.version_at(replay.parse_moment(a.at).timestamp()), dry_run=not a.run))
    return 0


if __name__ == "__main__":
    sys.exit(main())
