"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column | str) -> Column:
    """Without white space, of any Unicode kind, at either end. ``trim`` removes only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def marked(*cols: Column | str) -> list[Column]:
    """Each column beside its null mark: a hash of these tells a null from an empty text and from a null next door."""
    found = [F.col(c) if isinstance(c, str) else c for c in cols]
    return [x for c in found for x in (c, c.isNull())]
