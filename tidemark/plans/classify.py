"""Applying a privacy scan to the control database."""

from __future__ import annotations

from tidemark.control.store import ControlStore, SourceObject
from tidemark.operators.privacy import Proposal


def apply_proposals(store: ControlStore, obj: SourceObject, proposals: list[Proposal]) -> int:
    """New columns are added and unclassified ones filled in; what somebody has classified stays. Returns the number of changes."""
    have, n = store.policies(obj), 0
    for p in proposals:
        old = have.get(p.column)
        if old is None:
            store.insert("column_metadata", source_object_id=obj.id, column_name=p.column, sensitivity=p.sensitivity, masking_strategy=p.masking, business_description=p.evidence)
        elif old["sensitivity"] == "none":
            store.update("column_metadata", {"id": old["id"]}, sensitivity=p.sensitivity, masking_strategy=p.masking, business_description=p.evidence)
        else:
            continue
        n += 1
    return n
