"""File statistics, compaction, clustering and vacuum of versioned tables."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.storage.fs import Files
from tidemark.storage.table import LAYOUT, Entry, VersionedTable

TARGET, SMALL = 128 << 20, 16 << 20
RETENTION_HOURS = 168
ZBITS = 6


@dataclass(frozen=True)
class FileStats:
    files: int
    bytes: int
    small: int


def file_stats(table: VersionedTable, small: int = SMALL) -> FileStats:
    files = table.manifest().files
    return FileStats(len(files), sum(f.bytes for f in files), sum(f.bytes < small for f in files))


def compact(table: VersionedTable, target: int = TARGET) -> int:
    """Rewrites files under the target size into ones about that large; larger files, and the files of buckets, stay. Nothing to merge, no commit."""
    m = table.manifest()
    small = [f for f in m.files if f.bytes < target and f.bucket is None]
    wanted = max(1, -(-sum(f.bytes for f in small) // target))
    if len(small) <= wanted:
        return m.version
    merged = table.stage(table._frame(m.struct, [f.path for f in small]).coalesce(wanted))
    return table.commit(m.version, "compact", m.struct, [*(f for f in m.files if f not in small), *merged], {"merged": len(small), "into": len(merged)})


def z_value(columns: list[Column]) -> Column:
    """The bits of rank columns, each of ZBITS, interleaved."""
    out = F.lit(0).cast("bigint")
    for bit in range(ZBITS):
        for i, c in enumerate(columns):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c.cast("bigint"), bit).bitwiseAND(F.lit(1)), bit * len(columns) + i))
    return out


def _scalar(df: DataFrame, name: str) -> Column:
    """A number in the order of the column's values; texts are spread by their hash."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return F.xxhash64(c).cast("double")


def ranks(df: DataFrame, columns: list[str]) -> list[Column]:
    """For each column the number of quantile boundaries at or under a value: an even spread over 2**ZBITS steps whatever the distribution. One pass finds all boundaries."""
    steps = 1 << ZBITS
    shares = [i / steps for i in range(1, steps)]
    found = df.agg(*(F.percentile_approx(_scalar(df, c), shares, 10_000).alias(f"e{i}") for i, c in enumerate(columns))).first()

    def rank(value: Column, edges: list[float]) -> Column:
        return F.coalesce(F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= value)), F.lit(0)) if edges else F.lit(0)

    return [rank(_scalar(df, c), sorted(set(found[i] or []))) for i, c in enumerate(columns)]


def zorder(table: VersionedTable, columns: list[str], files: int | None = None) -> int:
    """Clusters the table along a Z curve and keeps each file's range of the columns, so that ``read_range`` skips files."""
    df = table.read()
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column(s) {', '.join(missing)}")
    m = table.manifest()
    n = files or max(1, -(-sum(f.bytes for f in m.files) // TARGET))
    z = z_value(ranks(df, columns))
    staged = table.stage(df.withColumn("__z", z).repartitionByRange(n, "__z").sortWithinPartitions("__z").drop("__z"))
    return table.commit(m.version, "zorder", m.struct, with_stats(table, m.struct, staged, columns), {"columns": columns}, {k: v for k, v in m.properties.items() if k != LAYOUT})


def with_stats(table: VersionedTable, schema: T.StructType, files: list[Entry], columns: list[str]) -> list[Entry]:
    """Each file with the least and greatest value of number and text columns."""
    plain = [c for c in columns if isinstance(schema[c].dataType, (T.NumericType, T.StringType)) and not isinstance(schema[c].dataType, T.DecimalType)]
    if not files or not plain:
        return files
    aggs = [x for c in plain for x in (F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi"))]
    rows = table._frame(schema, [f.path for f in files]).groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("__f")).agg(*aggs).collect()  # one row per file
    found = {r["__f"]: {c: [r[f"{c}__lo"], r[f"{c}__hi"]] for c in plain} for r in rows}
    return [Entry(f.path, f.bytes, f.bucket, found.get(f.path.rsplit("/", 1)[-1], {})) for f in files]


def is_quarantine(path: str) -> bool:
    return "quarantine" in path.strip("/").split("/")


def vacuum(table: VersionedTable, hours: float = RETENTION_HOURS, dry_run: bool = True, enforce: bool = True) -> list[str]:
    """Paths of files that no version of the last ``hours`` names, deleted unless ``dry_run``. The newest version always counts as kept."""
    if is_quarantine(table.root):
        raise ValueError("quarantined rows are evidence and aren't vacuumed")
    if enforce and hours < RETENTION_HOURS:
        raise ValueError(f"at least {RETENTION_HOURS} hours must be kept")
    edge = time.time() - hours * 3600
    history = table.history()
    kept = [m for i, m in enumerate(history) if m.ts >= edge or i == len(history) - 1]
    # a version holds until the next one, so the last one before the edge is needed too
    before = [m for m in history if m.ts < edge]
    live = {table.relative(f.path) for m in [*kept, *before[-1:]] for f in m.files}
    dead = [f.path for f in table.files.walk(f"{table.root}/data") if table.relative(f.path) not in live and f.modified_ms / 1000 < edge]
    if not dry_run:
        for path in dead:
            table.files.delete(path)
    return dead


def tables_under(spark: SparkSession, root: str) -> list[str]:
    """Folders with a version log, found by their manifests."""
    found = {f.path.rsplit("/_log/", 1)[0] for f in Files(spark, root).walk(root, ".json") if "/_log/" in f.path}
    return sorted(found)
