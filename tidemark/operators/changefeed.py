"""Applying a stream of inserts, updates and deletes to a table stored in hash buckets.

Every object of the feed has its own hash buckets, and the table's files each belong to one of them. A batch of changes is folded to one change per key, routed to its buckets, and joined by
sort-merge with the files of the touched buckets only; these buckets are written anew and a manifest that names them beside the untouched files is committed. Readers
see the old version until then, and a failed batch leaves only files that no manifest names.

How many buckets an object has is decided when it first appears, from the size of its changes, and kept in the manifest; nothing that a session or a caller says later changes it. ``rebucket`` writes the
table anew where an object has outgrown its buckets.

Keys' last changes stay in the table with their order value, deletes as tombstones, so that late and repeated changes of any later batch are
judged against what has been applied: batches may cut the feed anywhere and the result is the same.

Defined cases: a later order value wins; a null order value is before all others; of changes with the same key and order value
the one with the highest number wins, where repeats (equal in all but number and arrival) count once with their lowest number; null key parts are values that equal each other; an unset or unknown operation is
no delete; a change of an object without settings has no key and is left out; an empty batch commits nothing.

Scale: changes are folded map-side, so that a hot key costs one row per task; after that every key has one row and buckets are even, a hot object having as many as its size needs. A batch reads and writes only
touched buckets: what the merge shuffles of the base are their rows. The driver sees one row per object and one number per touched bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import strip
from tidemark.storage.keyed import PER_BUCKET, SEPARATOR, bucket_of
from tidemark.storage.table import LAYOUT, CommitConflict, VersionedTable, nullable

STATE = ["object", "key", "ord", "change_no", "is_delete", "payload"]


def field_named(df: DataFrame, name: Column, columns: list[str] | None = None) -> Column:
    """The text of the column whose name another column holds; null if there is none of that name."""
    pairs = [x for c in (columns or df.columns) for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    return F.create_map(*pairs)[name]


def normalised(changes: DataFrame, settings: DataFrame, *, obj: str, number: str, arrived_at: str) -> DataFrame:
    """STATE rows of raw changes. ``settings``: object, primary_key_columns, cdc_operation_column, cdc_delete_value, incremental_column."""
    payload = [c for c in changes.columns if c not in (obj, number, arrived_at)]
    s = settings.select(F.col("object").alias("_object"), F.split("primary_key_columns", ",").alias("_keys"), F.col("cdc_operation_column").alias("_op"), F.col("cdc_delete_value").alias("_del"), F.col("incremental_column").alias("_ord"))
    both = changes.join(s, F.col(obj) == F.col("_object")).filter("_keys is not null")
    values = lambda name: field_named(changes, name)
    lowered = lambda c: F.lower(strip(c))
    # timestamps are ordered as microseconds, numbers as they are
    order = F.create_map(*(x for c, t in changes.dtypes if t in ("bigint", "int", "smallint", "tinyint") or t.startswith("timestamp") for x in (F.lit(c), F.unix_micros(F.col(f"`{c}`").cast("timestamp")) if t.startswith("timestamp") else F.col(f"`{c}`").cast("bigint"))))
    return both.select(
        F.col(obj).alias("object"),
        F.transform("_keys", lambda k: values(F.trim(k))).alias("key"),
        order[F.trim("_ord")].alias("ord"),
        F.col(number).alias("change_no"),
        F.coalesce(lowered(values(F.trim("_op"))) == lowered(F.col("_del")), F.lit(False)).alias("is_delete"),
        F.struct(*(F.col(f"`{c}`") for c in payload)).alias("payload"),
    )


def folded(changes: DataFrame) -> DataFrame:
    """The winning change of each key in a batch."""
    once = changes.groupBy("object", "key", "ord", "is_delete", "payload").agg(F.min("change_no").alias("change_no"))
    return once.groupBy("object", "key").agg(F.max(F.struct("ord", "change_no", "is_delete", "payload")).alias("x")).select("object", "key", "x.*")


class BucketedTable:
    """``per_bucket``: keys that a bucket of a new object shall hold at most."""

    def __init__(self, spark: SparkSession, root: str, per_bucket: int = PER_BUCKET):
        self.spark, self.per_bucket = spark, per_bucket
        self.table = VersionedTable(spark, root)

    # -- layout -------------------------------------------------------------------------------
    def layout(self, version: int | None = None) -> dict[str, list[int]]:
        """For each object the number of its first bucket and how many it has."""
        return self.table.manifest(version).properties[LAYOUT] if self.table.exists() else {}

    def extended(self, layout: dict[str, list[int]], sizes: dict[str, int]) -> dict[str, list[int]]:
        """The layout with buckets for objects it doesn't have yet; those it has keep theirs."""
        out, top = dict(layout), max((a + n for a, n in layout.values()), default=0)
        for name in sorted(sizes.keys() - layout.keys(), key=lambda x: (len(x), x)):
            out[name] = [top, max(1, -(-sizes[name] // self.per_bucket))]
            top += out[name][1]
        return out

    @staticmethod
    def bucket(layout: dict[str, list[int]]) -> Column:
        """The bucket of a row: first bucket of its object plus the key's hash."""
        of = F.create_map(*(x for name, (first, n) in layout.items() for x in (F.lit(name), F.struct(F.lit(first).alias("first"), F.lit(n).alias("n")))))[F.col("object").cast("string")]
        text = F.array_join(F.transform("key", lambda k: F.coalesce(F.concat(F.lit("v"), k), F.lit("n"))), SEPARATOR)
        return (of["first"] + bucket_of(text, of["n"])).cast("int")

    # -- changes ------------------------------------------------------------------------------
    def apply(self, changes: DataFrame, retries: int = 3) -> int:
        """Applies normalised changes as one commit and returns the version; -1 or the old version if there are none."""
        for attempt in range(retries + 1):
            try:
                return self._apply(changes)
            except CommitConflict:
                if attempt == retries:
                    raise
        raise AssertionError

    def _apply(self, changes: DataFrame) -> int:
        base = self.table.version()
        old = self.table.manifest(base) if base >= 0 else None
        batch = folded(changes).persist()
        try:
            sizes = {str(r["object"]): r["count"] for r in batch.groupBy("object").count().collect()}
            if not sizes:
                return base
            layout = self.extended(old.properties[LAYOUT] if old else {}, sizes)
            placed = batch.withColumn("bucket", self.bucket(layout))
            touched = {r.bucket for r in placed.select("bucket").distinct().collect()}
            own = [f for f in old.files if f.bucket in touched] if old else []
            kept = [f for f in old.files if f.bucket not in touched] if old else []
            merged = self._merge(self.table._frame(old.struct, [f.path for f in own]).withColumn("bucket", self.bucket(layout)), placed) if own else placed.select("bucket", *STATE)
            new = self._stage(merged, len(touched))
            schema = old.struct if old else nullable(batch.select(*STATE).schema)
            return self.table.commit(base, "apply", schema, [*kept, *new], {"touched": len(touched), "kept": len({f.bucket for f in kept})}, {**(old.properties if old else {}), LAYOUT: layout})
        finally:
            batch.unpersist()

    def _stage(self, rows: DataFrame, touched: int):
        tasks = max(1, min(touched, 4 * self.spark.sparkContext.defaultParallelism))
        return self.table.stage(rows.repartition(tasks, "bucket").sortWithinPartitions("bucket", "object", "key"), "bucket")

    def _merge(self, base: DataFrame, batch: DataFrame) -> DataFrame:
        """Full outer sort-merge by bucket and key; a key on both sides keeps the winner."""
        on = (F.col("b.bucket") == F.col("c.bucket")) & (F.col("b.object") == F.col("c.object")) & (F.col("b.key") == F.col("c.key"))
        rank = lambda s: F.struct(*(F.col(f"{s}.{c}") for c in ("ord", "change_no", "is_delete", "payload")))
        repeat = F.expr("b.ord <=> c.ord and b.payload <=> c.payload and b.is_delete = c.is_delete")
        keep_base = F.col("c.object").isNull() | (F.col("b.object").isNotNull() & F.when(repeat, F.col("b.change_no") <= F.col("c.change_no")).otherwise(rank("b") > rank("c")))
        both = base.alias("b").hint("merge").join(batch.alias("c"), on, "full_outer")
        return both.select(*(F.when(keep_base, F.col(f"b.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in ("bucket", *STATE)))

    def rebucket(self) -> int:
        """Writes all rows into buckets fit for the objects' present sizes."""
        base = self.table.version()
        old = self.table.manifest(base)
        rows = self.table.read(base)
        layout = self.extended({}, {str(r["object"]): r["count"] for r in rows.groupBy("object").count().collect()})
        files = self._stage(rows.withColumn("bucket", self.bucket(layout)), sum(n for _, n in layout.values()))
        return self.table.commit(base, "rebucket", old.struct, files, {}, old.properties | {LAYOUT: layout})

    def current(self) -> DataFrame:
        """One row per key that is alive: object, key, ord, change_no, payload."""
        return self.table.read().filter("not is_delete").drop("is_delete")
