"""Going back: versions at a moment, restore, and rewinding a watermark."""

from __future__ import annotations

from datetime import UTC, datetime

from tidemark.control.store import ControlStore, SourceObject, now
from tidemark.operators.watermark import decode, encode


def parse_moment(text: str) -> datetime:
    """A date is its midnight, and a time without a zone is UTC."""
    at = datetime.fromisoformat(text.strip())
    return at if at.tzinfo else at.replace(tzinfo=UTC)


def rewind(store: ControlStore, obj: SourceObject, moment: datetime, dry_run: bool = True) -> tuple[str, str]:
    """Sets an incremental object's watermark back to a moment, so that the next run reads from there. Kept as a task run. Returns (from, to)."""
    if obj.load_strategy != "incremental":
        raise ValueError(f"{obj.object_name} isn't loaded incrementally")
    mark = store.one("SELECT * FROM load_watermark WHERE source_object_id = ?", obj.id)
    if mark is None:
        raise LookupError(f"{obj.object_name} has no watermark")
    kind = mark["watermark_type"]
    if kind == "string":
        raise ValueError("a text watermark can't be set to a moment")
    to = moment if kind == "timestamp" else int(moment.timestamp())
    if to > decode(mark["watermark_value"], kind):
        raise ValueError(f"{encode(to)} is after the watermark {mark['watermark_value']}")
    if not dry_run:
        with store.run("rewind") as run_id, store.task(run_id, obj, "bronze") as task:
            store.update("load_watermark", {"source_object_id": obj.id}, watermark_value=encode(to), committed_run_id=run_id, updated_at=now())
            task.update(watermark_from=mark["watermark_value"], watermark_to=encode(to))
    return mark["watermark_value"], encode(to)
