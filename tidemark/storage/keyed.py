"""Copy-on-write tables in hash buckets of a key.

The layout (key columns and number of buckets) is written in the manifest when the table is made and read from there ever after: no setting of a session can change where a key lives. A merge routes its
batch to buckets, reads the files of these buckets only, and commits their replacements beside the untouched files. A table may have a second, append-only
part: files without a bucket, which merges add to and never read (closed versions of a history).

The hash is MD5 over a text of the key, so that any engine can find a key's bucket: ``v`` before each part, ``n`` for a null, joined by the unit separator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.storage.table import LAYOUT, CommitConflict, Manifest, VersionedTable, nullable

BUCKET = "__bucket"
PER_BUCKET = 100_000
SEPARATOR = "\x1f"


def bucket_of(key_text: Column, buckets: Column | int) -> Column:
    """The first 60 bits of the key's MD5 modulo the number of buckets."""
    return F.pmod(F.conv(F.substring(F.md5(key_text), 1, 15), 16, 10).cast("bigint"), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def key_text(parts: list[Column]) -> Column:
    return F.concat_ws(SEPARATOR, *(F.coalesce(F.concat(F.lit("v"), p.cast("string")), F.lit("n")) for p in parts))


class LayoutError(ValueError):
    """A table is opened with another layout than it has."""


class KeyedTable:
    def __init__(self, table: VersionedTable, keys: list[str], per_bucket: int = PER_BUCKET):
        self.table, self.keys, self.per_bucket = table, keys, per_bucket

    @property
    def spark(self) -> SparkSession:
        return self.table.spark

    def layout(self, m: Manifest | None) -> dict | None:
        """The stored layout, or None for a table without one."""
        found = m.properties.get(LAYOUT) if m else None
        if found and found["keys"] != self.keys:
            raise LayoutError(f"{self.table.root} is bucketed by {', '.join(found['keys'])}, not {', '.join(self.keys)}")
        return found

    def bucket(self, buckets: int) -> Column:
        return bucket_of(key_text([F.col(f"`{k}`") for k in self.keys]), buckets)

    def _stage(self, df: DataFrame, buckets: int, touched: int):
        """Files by bucket, sorted by key; as many tasks as buckets, so that no bucket is cut into many files."""
        tasks = max(1, min(touched, 4 * self.spark.sparkContext.defaultParallelism))
        placed = df.withColumn(BUCKET, self.bucket(buckets)).repartition(tasks, BUCKET).sortWithinPartitions(BUCKET, *(f"`{k}`" for k in self.keys))
        return self.table.stage(placed, BUCKET)

    def create(self, df: DataFrame, rows: int, operation: str = "create", metrics: dict | None = None) -> int:
        """Writes ``df`` as the table's content in buckets fit for ``rows`` rows; the schema may change."""
        base = self.table.version()
        buckets = max(1, -(-rows // self.per_bucket))
        files = self._stage(df, buckets, buckets)
        return self.table.commit(base, operation, nullable(df.schema), files, {"touched": buckets, "kept": 0} | (metrics or {}), {LAYOUT: {"keys": self.keys, "buckets": buckets}})

    def touched(self, batch: DataFrame, buckets: int) -> list[int]:
        """The buckets that a batch has keys in: at most ``buckets`` numbers."""
        return sorted(r[0] for r in batch.select(self.bucket(buckets)).distinct().collect())

    def merge(
        self, batch: DataFrame | None, merged: Callable[[DataFrame], tuple[DataFrame, DataFrame | None] | None], schema: T.StructType, operation: str, metrics: Callable[[], dict] | dict | None = None, retries: int = 3
    ) -> int:
        """Replaces the buckets that ``batch`` (None: every one) touches by what ``merged`` makes of their rows, and commits once.

        ``merged`` gets the stored rows of the touched buckets and returns their replacement, and rows for the append-only part or None; or None alone if nothing is to be committed. A table without a layout is put into buckets by its first merge.
        """
        for attempt in range(retries + 1):
            base = self.table.version()
            m = self.table.manifest(base)
            layout = self.layout(m)
            if layout is None:
                buckets, touched, own = max(1, -(-self.table.read(base).count() // self.per_bucket)), None, list(m.files)
            else:
                buckets = layout["buckets"]
                touched = self.touched(batch, buckets) if batch is not None else None
                own = [f for f in m.files if f.bucket is not None and (touched is None or f.bucket in touched)]
            made = merged(self.table._frame(m.struct, [f.path for f in own]))
            if made is None:
                return base
            new, closed = made
            files = self._stage(new, buckets, len(touched) if touched is not None else buckets)
            files += self.table.stage(closed) if closed is not None else []
            kept = [f for f in m.files if f not in own]
            figures = {"touched": len(touched) if touched is not None else buckets, "kept": len({f.bucket for f in kept if f.bucket is not None}), **((metrics() if callable(metrics) else metrics) or {})}
            try:
                return self.table.commit(base, operation, nullable(schema), [*kept, *files], figures, m.properties | {LAYOUT: {"keys": self.keys, "buckets": buckets}})
            except CommitConflict:
                if attempt == retries:
                    raise
        raise AssertionError
