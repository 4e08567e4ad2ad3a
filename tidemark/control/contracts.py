"""Data contracts in YAML: what a source promises, compiled into quality rules."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame

from tidemark.control.store import ENUMS, ControlStore

MARK = "contract"
#: Spark's name for each type name a contract may use; fixed values.
SPARK_TYPES = {"string": "string", "large_string": "string", "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float": "float", "double": "double", "bool": "boolean", "timestamp[us, tz=UTC]": "timestamp", "timestamp[us]": "timestamp_ntz", "date32[day]": "date"}


class ContractError(ValueError):
    pass


def _strict(cls, raw: Any, where: str):
    """An instance from a mapping; unknown and missing names are errors."""
    if not isinstance(raw, dict):
        raise ContractError(f"{where}: expected a mapping")
    known = {f.name for f in fields(cls)}
    unknown = sorted(set(raw) - known)
    if unknown:
        raise ContractError(f"{where}: unknown {', '.join(unknown)}")
    try:
        return cls(**raw)
    except TypeError as e:
        raise ContractError(f"{where}: {e}") from e


def _severity(value: str, where: str) -> None:
    if value not in ENUMS["severity"]:
        raise ContractError(f"{where}: severity {value!r}")


@dataclass
class Expectation:
    unique: bool = False
    allowed_values: list | None = None
    minimum: float | None = None
    maximum: float | None = None
    pattern: str | None = None
    severity: str = "warn"

    def __post_init__(self):
        _severity(self.severity, "expect")
        if not self.unique and all(v is None for v in (self.allowed_values, self.minimum, self.maximum, self.pattern)):
            raise ContractError("nothing is expected: give unique, allowed_values, minimum, maximum or pattern")
        if self.minimum is not None and self.maximum is not None and self.minimum > self.maximum:
            raise ContractError(f"no value can be between {self.minimum} and {self.maximum}")

    def rules(self, column: str) -> list[dict]:
        out = [("unique", {})] if self.unique else []
        if self.allowed_values is not None:
            out.append(("allowed_values", {"values": self.allowed_values}))
        bounds = {k: v for k, v in (("minimum", self.minimum), ("maximum", self.maximum)) if v is not None}
        if bounds:
            out.append(("range", bounds))
        if self.pattern is not None:
            out.append(("regex", {"pattern": self.pattern}))
        return [{"rule_type": t, "column_name": column, "severity": self.severity, "expression": {**p, MARK: True}} for t, p in out]


@dataclass
class ContractColumn:
    name: str
    type: str
    nullable: bool = True
    description: str | None = None
    expect: Expectation | None = None
    null_severity: str = "fail"

    def __post_init__(self):
        _severity(self.null_severity, self.name)
        if isinstance(self.expect, dict):
            self.expect = _strict(Expectation, self.expect, self.name)
        if self.nullable and self.null_severity != "fail":
            raise ContractError(f"{self.name} may be null, so null_severity means nothing")


@dataclass
class Contract:
    source_system: str
    object: str
    owner: str
    version: int = 1
    description: str | None = None
    freshness_sla_minutes: int | None = None
    freshness_column: str | None = None
    columns: list = field(default_factory=list)

    def __post_init__(self):
        if self.version != 1:
            raise ContractError(f"contract version {self.version} isn't known")
        self.columns = [c if isinstance(c, ContractColumn) else _strict(ContractColumn, c, f"column {i}") for i, c in enumerate(self.columns)]
        names = [c.name for c in self.columns]
        if not names:
            raise ContractError("a contract needs a column")
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ContractError(f"columns stated twice: {', '.join(twice)}")
        if self.freshness_sla_minutes is not None and (self.freshness_sla_minutes <= 0 or self.freshness_column is None):
            raise ContractError("freshness_sla_minutes must be positive and needs freshness_column")
        if self.freshness_column is not None and self.freshness_column not in names:
            raise ContractError(f"freshness_column {self.freshness_column} isn't in the contract")

    def rules(self) -> list[dict]:
        out = []
        for c in self.columns:
            if not c.nullable:
                out.append({"rule_type": "not_null", "column_name": c.name, "severity": c.null_severity, "expression": {MARK: True}})
            if c.expect:
                out += c.expect.rules(c.name)
        if self.freshness_sla_minutes is not None:
            out.append({"rule_type": "freshness", "column_name": self.freshness_column, "severity": "warn", "expression": {"max_age_minutes": self.freshness_sla_minutes, MARK: True}})
        return out


def load(path: str | Path) -> list[Contract]:
    """One file, or all of a folder and the folders in it in the order of their paths; errors name the file."""
    path = Path(path)
    found: dict[tuple[str, str], Path] = {}
    out = []
    for f in sorted([*path.rglob("*.yml"), *path.rglob("*.yaml")]) if path.is_dir() else [path]:
        try:
            c = _strict(Contract, yaml.safe_load(f.read_text()), "contract")
        except (ContractError, yaml.YAMLError) as e:
            raise ContractError(f"{f}: {e}") from e
        key = (c.source_system, c.object)
        if key in found:
            raise ContractError(f"{f}: {c.source_system}.{c.object} already has the contract {found[key]}")
        found[key] = f
        out.append(c)
    return out


def conformance(contract: Contract, df: DataFrame) -> list[str]:
    """What the frame breaks: missing and wrongly typed columns. More columns than promised are fine."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    out = [f"{c.name} is missing" for c in contract.columns if c.name not in have]
    return out + [f"{c.name} is {have[c.name]}, not {c.type}" for c in contract.columns if c.name in have and have[c.name] != SPARK_TYPES.get(c.type, c.type)]


def sync(store: ControlStore, contract: Contract) -> int:
    """Replaces the rules that contracts made, sets owner and freshness; rules made by hand stay."""
    obj = store.one("SELECT o.id FROM source_object o JOIN source_system s ON s.id = o.source_system_id WHERE s.name = ? AND o.object_name = ?", contract.source_system, contract.object)
    if obj is None:
        raise LookupError(f"no object {contract.source_system}.{contract.object}")
    store.update("source_object", {"id": obj["id"]}, owner=contract.owner, freshness_sla_minutes=contract.freshness_sla_minutes)
    for r in store.rows("SELECT id, expression FROM dq_rule WHERE source_object_id = ?", obj["id"]):
        try:
            own = json.loads(r["expression"] or "{}").get(MARK) is True
        except (ValueError, AttributeError):
            own = False
        if own:
            with store.db:
                store.db.execute("DELETE FROM dq_rule WHERE id = ?", (r["id"],))
    rules = contract.rules()
    for r in rules:
        store.insert("dq_rule", source_object_id=obj["id"], rule_type=r["rule_type"], column_name=r["column_name"], severity=r["severity"], expression=json.dumps(r["expression"]))
    return len(rules)
