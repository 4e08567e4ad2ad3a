"""Column and path names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame

PROVENANCE = ("_ingested_at", "_run_id", "_source")


def snake_case(name: str) -> str:
    """``OrderID`` -> ``order_id``, ``  Weird--Name  `` -> ``weird_name``."""
    split = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"[^A-Za-z0-9]+", "_", split).strip("_").lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """All columns in snake case. A provenance column whose name a business column needs keeps its leading underscore; any other clash is refused."""
    plain = {c: snake_case(c) for c in df.columns}
    business = {n for c, n in plain.items() if c not in PROVENANCE}
    names = [c if c in PROVENANCE and plain[c] in business else plain[c] for c in df.columns]
    clashes = sorted(n for n, k in Counter(names).items() if k > 1)
    if clashes:
        raise ValueError(f"several columns would be named {', '.join(clashes)}")
    return df.toDF(*names)


def require_columns(df: DataFrame, names: Iterable[str], context: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"{context}: missing column(s) {', '.join(missing)}")


def csv_list(text: str | None) -> list[str]:
    return [x.strip() for x in (text or "").split(",") if x.strip()]


def layer_path(bronze: str, layer: str) -> str:
    """The path of an object in another layer, from its bronze path: ``bronze/x`` -> ``silver/x``; other paths get the layer in front."""
    head, _, tail = bronze.partition("/")
    return f"{layer}/{tail}" if head == "bronze" and tail else f"{layer}/{bronze}"


def gold_path(object_name: str, role: str) -> str:
    return f"gold/{'dim' if role == 'dimension' else 'fact'}_{snake_case(object_name)}"
