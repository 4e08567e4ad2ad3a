"""The control database: configuration, state and audit rows in SQLite. Analysis of it runs in Spark (``plans.audit``)."""

from __future__ import annotations

import json
import sqlite3
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

from tidemark.functions.names import csv_list

#: Vocabularies; fixed values.
ENUMS = {
    "load_strategy": ("full", "incremental", "cdc"),
    "layer": ("bronze", "silver", "gold"),
    "watermark_type": ("timestamp", "integer", "string"),
    "status": ("running", "succeeded", "failed", "skipped", "quarantined"),
    "severity": ("warn", "quarantine", "fail"),
    "rule_type": ("not_null", "unique", "range", "allowed_values", "regex", "freshness", "row_count", "custom_sql"),
    "gold_role": ("fact", "dimension"),
    "sensitivity": ("none", "internal", "pii", "sensitive_pii"),
    "masking_strategy": ("none", "hash", "redact", "partial"),
    "kind": ("jdbc", "rest", "file", "object_store"),
}
_OBJECT = "source_object_id INTEGER NOT NULL REFERENCES source_object(id) ON DELETE CASCADE"
_STAMPS = ["created_at TEXT NOT NULL DEFAULT CURRENT_TIMESTAMP", "updated_at TEXT NOT NULL DEFAULT CURRENT_TIMESTAMP"]
_ID = "id INTEGER PRIMARY KEY"


def _one_of(column: str, nullable: bool = False) -> str:
    allowed = ", ".join(f"'{v}'" for v in ENUMS[column])
    return f"{column} TEXT {'' if nullable else 'NOT NULL '}CHECK ({column} IN ({allowed}))"


TABLES: dict[str, list[str]] = {
    "source_system": [_ID, "name TEXT NOT NULL UNIQUE", _one_of("kind"), "secret_name TEXT", "active INTEGER NOT NULL DEFAULT 1", *_STAMPS],
    "source_object": [
        _ID, "source_system_id INTEGER NOT NULL REFERENCES source_system(id) ON DELETE CASCADE", "schema_name TEXT NOT NULL", "object_name TEXT NOT NULL", "target_path TEXT NOT NULL",
        _one_of("load_strategy"), "incremental_column TEXT", "primary_key_columns TEXT", "cdc_operation_column TEXT", "cdc_delete_value TEXT NOT NULL DEFAULT 'D'",
        "watermark_grace INTEGER NOT NULL DEFAULT 0", "load_order INTEGER NOT NULL DEFAULT 100", "active INTEGER NOT NULL DEFAULT 1", "scd2_enabled INTEGER NOT NULL DEFAULT 0",
        _one_of("gold_role", nullable=True), "freshness_sla_minutes INTEGER", "owner TEXT", *_STAMPS, "UNIQUE (source_system_id, schema_name, object_name)",
        "CHECK (load_strategy <> 'incremental' OR incremental_column IS NOT NULL)", "CHECK (load_strategy <> 'cdc' OR primary_key_columns IS NOT NULL)",
        "CHECK (gold_role IS NULL OR gold_role <> 'dimension' OR primary_key_columns IS NOT NULL)",
    ],
    "gold_reference": [
        _ID, "fact_object_id INTEGER NOT NULL REFERENCES source_object(id) ON DELETE CASCADE", "dimension_object_id INTEGER NOT NULL REFERENCES source_object(id) ON DELETE CASCADE",
        "fact_column TEXT NOT NULL", *_STAMPS, "UNIQUE (fact_object_id, fact_column)", "CHECK (fact_object_id <> dimension_object_id)",
    ],
    "column_metadata": [
        _ID, _OBJECT, "column_name TEXT NOT NULL", _one_of("sensitivity"), _one_of("masking_strategy"), "allow_in_gold INTEGER NOT NULL DEFAULT 0", "business_description TEXT", *_STAMPS,
        "UNIQUE (source_object_id, column_name)", "CHECK (sensitivity <> 'none' OR masking_strategy = 'none')",
    ],
    "dq_rule": [_ID, _OBJECT, _one_of("rule_type"), "column_name TEXT", "expression TEXT", _one_of("severity"), "active INTEGER NOT NULL DEFAULT 1", *_STAMPS],
    "object_dependency": [_ID, _OBJECT, "depends_on_id INTEGER NOT NULL REFERENCES source_object(id) ON DELETE CASCADE", "UNIQUE (source_object_id, depends_on_id)", "CHECK (source_object_id <> depends_on_id)"],
    "load_watermark": ["source_object_id INTEGER PRIMARY KEY REFERENCES source_object(id) ON DELETE CASCADE", "watermark_value TEXT NOT NULL", _one_of("watermark_type"), "committed_run_id TEXT", "updated_at TEXT NOT NULL DEFAULT CURRENT_TIMESTAMP"],
    "schema_version": [_ID, _OBJECT, "version INTEGER NOT NULL", "schema_json TEXT NOT NULL", "schema_hash TEXT NOT NULL", "is_current INTEGER NOT NULL", "captured_at TEXT NOT NULL DEFAULT CURRENT_TIMESTAMP", "UNIQUE (source_object_id, version)"],
    "pipeline_run": ["run_id TEXT PRIMARY KEY", "pipeline_name TEXT NOT NULL", "triggered_by TEXT", _one_of("status"), "started_at TEXT NOT NULL", "ended_at TEXT"],
    "task_run": [
        _ID, "run_id TEXT NOT NULL REFERENCES pipeline_run(run_id) ON DELETE CASCADE", _OBJECT, _one_of("layer"), _one_of("status"), "rows_read INTEGER NOT NULL DEFAULT 0", "rows_written INTEGER NOT NULL DEFAULT 0",
        "rows_rejected INTEGER NOT NULL DEFAULT 0", "watermark_from TEXT", "watermark_to TEXT", "error_message TEXT", "started_at TEXT NOT NULL", "ended_at TEXT", "duration_seconds REAL",
    ],
    "dq_result": [_ID, "task_run_id INTEGER NOT NULL REFERENCES task_run(id) ON DELETE CASCADE", "dq_rule_id INTEGER NOT NULL REFERENCES dq_rule(id) ON DELETE CASCADE", "passed INTEGER NOT NULL", "failed_row_count INTEGER NOT NULL", "detail TEXT", "evaluated_at TEXT NOT NULL DEFAULT CURRENT_TIMESTAMP"],
}


#: What each database calls the types above; keys and looked-up texts need a length in SQL Server.
DIALECTS = {
    "sqlite": {},
    "postgres": {"INTEGER PRIMARY KEY": "BIGINT GENERATED BY DEFAULT AS IDENTITY PRIMARY KEY", "INTEGER": "BIGINT", "REAL": "DOUBLE PRECISION", "DEFAULT CURRENT_TIMESTAMP": "DEFAULT (CURRENT_TIMESTAMP::TEXT)"},
    "mssql": {"INTEGER PRIMARY KEY": "BIGINT IDENTITY(1,1) PRIMARY KEY", "INTEGER": "BIGINT", "REAL": "FLOAT", "TEXT": "NVARCHAR(400)", "DEFAULT CURRENT_TIMESTAMP": "DEFAULT (CONVERT(NVARCHAR(40), SYSUTCDATETIME(), 126))"},
}
_LONG = ("schema_json", "expression", "error_message", "detail", "business_description")


def _column(text: str, dialect: str) -> str:
    name = text.split()[0]
    if name in ("UNIQUE", "CHECK"):
        return text
    if "INTEGER PRIMARY KEY" in text and name != "id":  # a key that is another table's
        text = text.replace("INTEGER PRIMARY KEY", "INTEGER NOT NULL UNIQUE")
    for a, b in DIALECTS[dialect].items():
        text = text.replace(a, b, 1) if a in text and not (a == "INTEGER" and "BIGINT" in text) else text
    if dialect == "mssql":
        text = text.replace("NVARCHAR(400)", "NVARCHAR(MAX)") if name in _LONG else text
        # it refuses several paths of cascades to one table
        text = text.replace(" ON DELETE CASCADE", "") if name in ("dimension_object_id", "depends_on_id", "dq_rule_id") else text
    return text


def ddl(dialect: str = "sqlite") -> str:
    """The control tables for SQLite, Postgres or SQL Server."""
    return "\n".join(f"CREATE TABLE {name} (\n  " + ",\n  ".join(c if dialect == "sqlite" else _column(c, dialect) for c in columns) + "\n);" for name, columns in TABLES.items())


#: Scripts by the version they lead to. A store without a version but with tables is taken as version 1.
MIGRATIONS: dict[int, list[str]] = {
    1: [*ddl().split(";\n")],
    2: ["CREATE INDEX IF NOT EXISTS ix_task_object ON task_run (source_object_id, started_at)", "CREATE INDEX IF NOT EXISTS ix_rule_object ON dq_rule (source_object_id, active)", "CREATE INDEX IF NOT EXISTS ix_result_task ON dq_result (task_run_id)"],
}


def now() -> str:
    return datetime.now(UTC).isoformat()


@dataclass(frozen=True)
class SourceObject:
    id: int
    source_system_id: int
    schema_name: str
    object_name: str
    target_path: str
    load_strategy: str
    incremental_column: str | None = None
    primary_key_columns: str | None = None
    cdc_operation_column: str | None = None
    cdc_delete_value: str = "D"
    watermark_grace: int = 0
    load_order: int = 100
    active: bool = True
    scd2_enabled: bool = False
    gold_role: str | None = None
    freshness_sla_minutes: int | None = None
    owner: str | None = None

    @property
    def keys(self) -> list[str]:
        return csv_list(self.primary_key_columns)


class ControlStore:
    def __init__(self, path: str = ":memory:"):
        self.db = sqlite3.connect(path, check_same_thread=False)
        self.db.row_factory = sqlite3.Row
        self.db.execute("PRAGMA foreign_keys = ON")

    # -- schema -------------------------------------------------------------------------------
    def version(self) -> int:
        found = self.db.execute("PRAGMA user_version").fetchone()[0]
        legacy = self.db.execute("SELECT count(*) FROM sqlite_master WHERE name = 'source_object'").fetchone()[0]
        return found or int(bool(legacy))

    def migrate(self, check: bool = False) -> list[int]:
        """Runs what is missing, and says which versions that are; with ``check`` only says so."""
        todo = [v for v in sorted(MIGRATIONS) if v > self.version()]
        if not check:
            for v in todo:
                with self.db:
                    for statement in MIGRATIONS[v]:
                        self.db.execute(statement)
                    self.db.execute(f"PRAGMA user_version = {v}")
        return todo

    # -- rows ---------------------------------------------------------------------------------
    def rows(self, sql: str, *args: Any) -> list[dict]:
        return [dict(r) for r in self.db.execute(sql, args)]

    def one(self, sql: str, *args: Any) -> dict | None:
        return next(iter(self.rows(sql, *args)), None)

    def insert(self, table: str, **values: Any) -> int:
        names = ", ".join(values)
        with self.db:
            return self.db.execute(f"INSERT INTO {table} ({names}) VALUES ({', '.join('?' * len(values))})", tuple(values.values())).lastrowid

    def update(self, table: str, key: dict, **values: Any) -> None:
        with self.db:
            self.db.execute(f"UPDATE {table} SET {', '.join(f'{c} = ?' for c in values)} WHERE {' AND '.join(f'{c} = ?' for c in key)}", (*values.values(), *key.values()))

    def upsert(self, table: str, key: dict, **values: Any) -> None:
        where = " AND ".join(f"{c} = ?" for c in key)
        if self.one(f"SELECT 1 AS x FROM {table} WHERE {where}", *key.values()):
            if values:
                self.update(table, key, **values)
        else:
            self.insert(table, **key, **values)

    # -- configuration ------------------------------------------------------------------------
    def objects(self, active_only: bool = True) -> list[SourceObject]:
        found = self.rows(f"SELECT * FROM source_object {'WHERE active = 1' if active_only else ''} ORDER BY load_order, id")
        return [self._object(r) for r in found]

    def object(self, object_id: int) -> SourceObject:
        found = self.one("SELECT * FROM source_object WHERE id = ?", object_id)
        if found is None:
            raise LookupError(f"no object {object_id}")
        return self._object(found)

    @staticmethod
    def _object(r: dict) -> SourceObject:
        return SourceObject(**{k: (bool(v) if k in ("active", "scd2_enabled") else v) for k, v in r.items() if k in SourceObject.__dataclass_fields__})

    # -- runs ---------------------------------------------------------------------------------
    @contextmanager
    def run(self, name: str, triggered_by: str | None = None, run_id: str | None = None) -> Iterator[str]:
        """A pipeline run that is always closed: with the status of its tasks, or as failed if the body raises."""
        run_id = run_id or uuid.uuid4().hex
        self.upsert("pipeline_run", {"run_id": run_id}, pipeline_name=name, triggered_by=triggered_by, status="running", started_at=now(), ended_at=None)
        try:
            yield run_id
        except BaseException:
            self.update("pipeline_run", {"run_id": run_id}, status="failed", ended_at=now())
            raise
        self.update("pipeline_run", {"run_id": run_id}, status=self.derived_status(run_id), ended_at=now())

    def derived_status(self, run_id: str) -> str:
        have = {r["status"] for r in self.rows("SELECT DISTINCT status FROM task_run WHERE run_id = ?", run_id)}
        return next((s for s in ("failed", "quarantined") if s in have), "succeeded")

    @contextmanager
    def task(self, run_id: str, obj: SourceObject, layer: str) -> Iterator[dict]:
        """A task row. The body fills the yielded dict; an error closes the task as failed and goes on up."""
        began = datetime.now(UTC)
        task_id = self.insert("task_run", run_id=run_id, source_object_id=obj.id, layer=layer, status="running", started_at=began.isoformat())
        out: dict = {"id": task_id, "status": "succeeded"}
        try:
            yield out
        except Exception as e:
            self._close(task_id, began, {**out, "status": "failed", "error_message": f"{type(e).__name__}: {e}"})
            raise
        self._close(task_id, began, out)

    def _close(self, task_id: int, began: datetime, out: dict) -> None:
        ended = datetime.now(UTC)
        columns = {c: out[c] for c in ("status", "rows_read", "rows_written", "rows_rejected", "watermark_from", "watermark_to", "error_message") if c in out}
        self.update("task_run", {"id": task_id}, **columns, ended_at=ended.isoformat(), duration_seconds=(ended - began).total_seconds())

    def policies(self, obj: SourceObject) -> dict[str, dict]:
        return {r["column_name"]: r for r in self.rows("SELECT * FROM column_metadata WHERE source_object_id = ?", obj.id)}

    def record_results(self, task_id: int, results: list) -> None:
        for r in results:
            self.insert("dq_result", task_run_id=task_id, dq_rule_id=r.rule.id, passed=int(r.passed), failed_row_count=r.failed_rows, detail=r.detail)

    def dump(self) -> str:
        return json.dumps({t: self.rows(f"SELECT * FROM {t}") for t in TABLES}, default=str)
