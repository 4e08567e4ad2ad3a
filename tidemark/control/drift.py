"""Schema versions of an object and the policy on their changes."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.control.store import ControlStore, SourceObject


class SchemaDriftError(RuntimeError):
    """A column was removed or retyped."""


@dataclass(frozen=True)
class Drift:
    kind: str  # none, additive, breaking
    added: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()
    retyped: tuple[str, ...] = ()


def describe(df: DataFrame) -> list[dict]:
    return [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in df.schema]


def schema_hash(columns: list[dict]) -> str:
    """Independent of the order of columns."""
    return hashlib.sha256(json.dumps(sorted(columns, key=lambda c: c["name"]), sort_keys=True).encode()).hexdigest()


def compare(old: list[dict], new: list[dict]) -> Drift:
    a, b = {c["name"]: c["type"] for c in old}, {c["name"]: c["type"] for c in new}
    added, removed = tuple(sorted(b.keys() - a.keys())), tuple(sorted(a.keys() - b.keys()))
    retyped = tuple(sorted(n for n in a.keys() & b.keys() if a[n] != b[n]))
    return Drift("breaking" if removed or retyped else "additive" if added else "none", added, removed, retyped)


def check(store: ControlStore, obj: SourceObject, df: DataFrame) -> Drift:
    """The drift against the current version; SchemaDriftError if it is breaking. Nothing is recorded."""
    current = store.one("SELECT * FROM schema_version WHERE source_object_id = ? AND is_current = 1", obj.id)
    if current is None:
        return Drift("none")
    found = compare(json.loads(current["schema_json"]), describe(df))
    if found.kind == "breaking":
        raise SchemaDriftError(f"{obj.object_name}: removed {list(found.removed)}, retyped {list(found.retyped)}")
    return found


def record(store: ControlStore, obj: SourceObject, columns: list[dict]) -> int:
    """Makes the schema current, as a new version if it differs in anything; called after the data's commit."""
    current = store.one("SELECT * FROM schema_version WHERE source_object_id = ? AND is_current = 1", obj.id)
    digest = schema_hash(columns)
    if current and current["schema_hash"] == digest:
        return current["version"]
    version = current["version"] + 1 if current else 1
    if current:
        store.update("schema_version", {"id": current["id"]}, is_current=0)
    store.insert("schema_version", source_object_id=obj.id, version=version, schema_json=json.dumps(columns), schema_hash=digest, is_current=1)
    return version
