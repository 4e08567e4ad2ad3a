"""Run events with column lineage, as JSON lines."""

from __future__ import annotations

import json
import logging
import uuid
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


class Lineage:
    """Appends START events before work begins and COMPLETE or FAIL events after it to a file of the driver; errors are logged and never reach the load."""

    def __init__(self, path: str, namespace: str = "tidemark"):
        self.path, self.namespace = Path(path), namespace

    def start(self, run_id: str, job: str, inputs: list[tuple[str, str]], output: str) -> dict:
        """Writes the START and returns what the other event of the run repeats."""
        base = {"run": uuid.uuid5(uuid.NAMESPACE_URL, f"{run_id}/{job}").hex, "parent": run_id, "job": job, "inputs": [{"namespace": n, "name": d} for n, d in inputs]}
        self._write({**base, "event": "START"})
        return {**base, "output": {"namespace": self.namespace, "name": output}}

    def complete(self, base: dict, df: DataFrame | None = None, columns: dict[str, list[str]] | None = None) -> None:
        """columns: output column -> the input columns it is made of."""
        facets = {"schema": [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema]} if df is not None else {}
        self._write({**base, "event": "COMPLETE", "output": {**base["output"], **facets, "columns": columns or {}}})

    def fail(self, base: dict, error: BaseException) -> None:
        self._write({**base, "event": "FAIL", "error": f"{type(error).__name__}: {error}"})

    def _write(self, event: dict) -> None:
        try:
            with self.path.open("a") as out:
                out.write(json.dumps({**event, "at": datetime.now(UTC).isoformat()}) + "\n")
        except Exception:  # noqa: BLE001 - lineage never breaks a load
            log.exception("lineage of %s wasn't written", event.get("job"))

    def events(self) -> list[dict]:
        return [json.loads(x) for x in self.path.read_text().splitlines()] if self.path.exists() else []
