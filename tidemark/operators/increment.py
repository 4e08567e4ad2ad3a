"""Processing only new or changed records, by partition fingerprints.

The source is divided into partitions by expressions of its content. A partition's fingerprint is its row count with two additive hashes of its rows, all of
which are partial aggregates. A run compares the fingerprints with those kept from the last successful run, reads only the partitions that
differ, and replaces each of them in the result by dynamic partition overwrite. The new fingerprints are published last, in one manifest: a run that dies
before leaves the old ones, and the next run recomputes the same partitions onto the same places, so nothing is skipped or repeated.

Since rows are replaced before the fingerprints are published, a run first takes the lease of the version it is going to publish. A second writer finds the lease taken and stops before it has touched a row. The lease
of a dead run can be taken over by the run's own retry (the same ``owner``) at once, by others once it has expired.

Defined cases: a partition that vanished is emptied; null partition values are a partition of their own; repeated rows change
the count and so the fingerprint; nothing changed writes nothing and publishes nothing; an empty source has no partitions.

Scale: fingerprints are one row per partition; a hot partition is split for writing by the rebalance hint, and never sits in one task. Source rows are hashed where they
are read and only changed partitions are shuffled.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import marked
from tidemark.runtime import materialise
from tidemark.storage.fs import Files
from tidemark.storage.table import CommitConflict, VersionedTable

PART = "_partition"


class IncrementalResult:
    """A result kept by partition beside the fingerprints it was computed from."""

    def __init__(self, spark: SparkSession, root: str, owner: str | None = None, lease_seconds: float = 6 * 3600):
        self.spark, self.root, self.owner, self.lease_seconds = spark, root.rstrip("/"), owner or uuid.uuid4().hex, lease_seconds
        self.marks = VersionedTable(spark, f"{self.root}/fingerprints")
        self.files = Files(spark, self.root)

    @staticmethod
    def fingerprints(rows: DataFrame, partition: Column) -> DataFrame:
        h = F.xxhash64(*marked(*(F.col(f"`{c}`") for c in rows.columns)))
        return rows.select(F.coalesce(partition.cast("string"), F.lit("none")).alias(PART), h.alias("h")).groupBy(PART).agg(
            F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("s"), F.bit_xor(F.xxhash64(F.lit(7), "h")).alias("x")
        )

    def take_lease(self, version: int) -> str:
        """The right to write what ``version`` will publish: the newest file of that version's leases, published without overwriting."""
        folder = f"{self.root}/leases/{version:020d}"
        taken = self.files.names(folder)
        if taken:
            last = json.loads(self.files.read_text(f"{folder}/{taken[-1]}"))
            if last["owner"] != self.owner and last["until"] > time.time():
                raise CommitConflict(f"{self.root}: {last['owner']} is writing version {version}")
        path = f"{folder}/{len(taken):06d}.json"
        if not self.files.publish(path, json.dumps({"owner": self.owner, "until": time.time() + self.lease_seconds})):
            raise CommitConflict(f"{self.root}: version {version} has just been taken")
        return path

    def run(self, rows: DataFrame, partition: Column, compute: Callable[[DataFrame], DataFrame]) -> dict:
        """Recomputes changed partitions. ``compute`` takes and returns rows with the column ``_partition``, which it must keep."""
        base = self.marks.version()
        self.take_lease(base + 1)
        now = self.fingerprints(rows, partition).persist()
        try:
            if base < 0:
                changed, vanished = now.select(PART), None
            else:
                before = self.marks.read(base)
                changed = now.join(before, [PART, "n", "s", "x"], "left_anti").select(PART)
                vanished = before.join(now, PART, "left_anti").select(PART)
            n_changed, n_vanished = changed.count(), vanished.count() if vanished is not None else 0
            if n_changed + n_vanished == 0:
                return {"changed": 0, "vanished": 0, "version": base}
            keyed = rows.withColumn(PART, F.coalesce(partition.cast("string"), F.lit("none")))
            if base >= 0:
                keyed = keyed.join(changed, PART, "left_semi")
            out = compute(keyed).withColumn("_real", F.lit(True))
            # a changed partition whose result is empty, and a vanished one, must lose its old rows: one marker row replaces them
            marks = changed.unionByName(vanished) if vanished is not None else changed
            out = out.unionByName(marks.withColumn("_real", F.lit(False)), allowMissingColumns=True)
            out.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(f"{self.root}/rows")
            files = self.marks.stage(now)
            version = self.marks.commit(base, "run", now.schema, files, {"changed": n_changed, "vanished": n_vanished, "at": time.time()}, {"schema": out.drop(PART).schema.json()})
            return {"changed": n_changed, "vanished": n_vanished, "version": version}
        finally:
            now.unpersist()

    def read(self) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.marks.manifest().properties["schema"]))
        schema = T.StructType([*schema, T.StructField(PART, T.StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/rows").filter("_real").drop("_real", PART)


__all__ = ["IncrementalResult", "CommitConflict", "PART"]


def first_of_repeats(rows: DataFrame, *, ignored: list[str], order: list[str], trimmed: Callable[[str], Column]) -> DataFrame:
    """One row of each group that is equal in all columns but ``ignored``: the first by ``order``.

    ``trimmed`` gives the compared form of a column. Extra columns named in both ``ignored`` and ``order`` are kept from the first row.
    """
    compared = [c for c in rows.columns if c not in ignored]
    first = rows.groupBy(*(trimmed(c).alias(f"_c{i}") for i, c in enumerate(compared))).agg(F.min(F.struct(*order, *(c for c in rows.columns if c not in order))).alias("x"))
    return first.select(*(F.col(f"x.`{c}`") for c in rows.columns))


def in_interval(rows: DataFrame, spans: DataFrame, *, obj: str, value: Column) -> DataFrame:
    """``rows`` with the columns of the span of their object that their value lies in; rows in none are left out.

    ``spans``: _obj, _after and _upto (numbers; null for no bound) of disjoint intervals (_after, _upto], and other columns. An object's intervals are laid over a grid that has as many cells as it has intervals, between its
    least and greatest bound, so that a row meets about one interval, however many rows or intervals an object has.
    """
    ends = spans.select("_obj", F.explode(F.array("_after", "_upto")).alias("e")).filter("e is not null")
    grid = ends.groupBy("_obj").agg(F.min("e").alias("_low"), F.max("e").alias("_high"), F.count("*").alias("_n"))
    grid = grid.select("_obj", "_low", "_n", F.greatest(F.lit(1), F.ceil((F.col("_high") - F.col("_low")) / F.col("_n"))).cast("bigint").alias("_width"))
    place = lambda c: F.greatest(F.lit(0), F.least(F.col("_n"), F.floor((c - F.col("_low")) / F.col("_width")))).cast("bigint")
    first, last = F.coalesce(place(F.col("_after")), F.lit(0).cast("bigint")), F.coalesce(place(F.col("_upto")), F.col("_n"))
    cells = spans.join(grid, "_obj").withColumn("_cell", F.explode(F.sequence(first, last))).drop("_low", "_n", "_width")
    placed = rows.withColumn("_value", value).join(grid.withColumnRenamed("_obj", "_at"), F.col(obj) == F.col("_at")).withColumn("_place", place(F.col("_value"))).drop("_at", "_low", "_n", "_width")
    on = (F.col(obj) == F.col("_obj")) & (F.col("_place") == F.col("_cell")) & (F.col("_upto").isNull() | (F.col("_value") <= F.col("_upto"))) & (F.col("_after").isNull() | (F.col("_value") > F.col("_after")))
    return placed.join(cells, on).drop("_obj", "_after", "_upto", "_cell", "_place", "_value")


def first_run_after(rows: DataFrame, runs: DataFrame, *, obj: str, arrived: str, started: str, run: str) -> DataFrame:
    """``rows`` with the first run of their object that started at or after they arrived; rows after the last run are left out.

    Runs become disjoint arrival intervals (previous start, start]. Of runs with one start the lowest counts.
    """
    one = runs.groupBy(obj, F.unix_micros(started).alias("_upto")).agg(F.min(run).alias("_run")).filter("_upto is not null")
    w = Window.partitionBy(obj).orderBy("_upto")
    spans = one.select(F.col(obj).alias("_obj"), F.lag("_upto").over(w).alias("_after"), "_upto", "_run")
    return in_interval(rows, spans, obj=obj, value=F.unix_micros(arrived)).withColumnRenamed("_run", run)


def run_watermarks(rows: DataFrame, runs: DataFrame, *, obj: str, arrived: str, started: str, run: str, value: str, grace: str) -> DataFrame:
    """For each run: obj, run, watermark_from, watermark_to, rows_new and rows_reprocessed.

    The watermark after a run is the greatest ``value`` of all rows that had arrived, and never falls. A run reads again the rows of earlier runs whose
    value is above its watermark_from less the object's grace. ``runs`` holds obj, run, started and grace (in the units of value; of several of an object the greatest). Rows with a null value don't count.

    As marks never fall, a row is read again by the runs from the one after its own to the last whose mark less the grace lies under its value. That one is looked up like an interval, and the runs' numbers are running sums of
    the rows that begin and end with each: no row is paired with the runs that read it.
    """
    w = Window.partitionBy(obj).orderBy("_start")
    first = first_run_after(rows.select(obj, arrived, F.col(value).alias("_v")).filter(F.col(arrived).isNotNull()), runs.select(obj, started, run), obj=obj, arrived=arrived, started=started, run=run)
    own = first.groupBy(obj, run).agg(F.count("*").alias("rows_new"), F.max("_v").alias("_max"))
    one = runs.groupBy(obj, F.col(started).alias("_start")).agg(F.min(run).alias(run), F.max(grace).alias("_grace")).filter("_start is not null")
    marks = materialise(
        one.join(own, [obj, run], "left")
        .withColumns({"watermark_to": F.max("_max").over(w), "_seq": F.row_number().over(w), "_grace": F.greatest(F.coalesce(F.max("_grace").over(Window.partitionBy(obj)), F.lit(0)), F.lit(0))})
        .withColumn("watermark_from", F.lag("watermark_to").over(w))
        .withColumns({"_edge": F.col("watermark_from") - F.col("_grace"), "rows_new": F.coalesce("rows_new", F.lit(0))})
        .withColumn("_edge1", F.lead("_edge").over(w)),
        "run-marks",
    )
    edges = marks.filter("_edge is not null").groupBy(obj, F.col("_edge").alias("_after")).agg(F.max("_seq").alias("_last"))
    spans = edges.select(F.col(obj).alias("_obj"), "_after", F.lead("_after").over(Window.partitionBy(obj).orderBy("_after")).alias("_upto"), "_last")
    late = first.join(marks.select(obj, run, "_seq", "_edge1"), [obj, run]).filter("_v > _edge1").select(obj, "_seq", "_v")
    counted = in_interval(late, spans, obj=obj, value=F.col("_v")).groupBy(obj, "_seq", "_last").agg(F.count("*").alias("_k"))
    steps = counted.select(obj, F.explode(F.array(F.struct((F.col("_seq") + 1).alias("_seq"), F.col("_k").alias("_step")), F.struct((F.col("_last") + 1).alias("_seq"), (-F.col("_k")).alias("_step")))).alias("x")).select(obj, "x.*")
    again = marks.join(steps.groupBy(obj, "_seq").agg(F.sum("_step").alias("_step")), [obj, "_seq"], "left")
    return again.select(obj, run, "watermark_from", "watermark_to", "rows_new", F.coalesce(F.sum("_step").over(Window.partitionBy(obj).orderBy("_seq")), F.lit(0)).alias("rows_reprocessed"))
