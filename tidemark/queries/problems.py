"""Queries of the data problems on the platform's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import strip
from tidemark.operators import asof, increment, merkle, profile, schemadrift, snapdiff
from tidemark.operators.changefeed import BucketedTable, normalised
from tidemark.operators.profile import ColumnSpec
from tidemark.runtime import materialise, new_path
from tidemark.sources.tables import table

# -- 1: column profiles -----------------------------------------------------------------------


def _specs() -> dict[str, list[ColumnSpec]]:
    c = F.col
    run_id = ColumnSpec("run_id", breaks=~c("run_id").rlike(r"^run_[0-9a-f]{12}\z"))
    outside = lambda n, most: (c(n) < 0) | (c(n) > most)
    # null > number is null, which counts as no break: each test stands alone
    above = lambda n, whole: F.coalesce(c(n) > c(whole), F.lit(False))
    return {
        "rule_performance": [
            ColumnSpec("evaluations", "number", outside("evaluations", 10_000_000)),
            ColumnSpec("failures", "number", outside("failures", 10_000_000) | above("failures", "evaluations")),
            ColumnSpec("severity", "category"),
            ColumnSpec("column_name", breaks=~c("column_name").rlike(r"^[a-z][a-z0-9]*(_[a-z0-9]+)*\z")),
            run_id,
        ],
        "stage_summary": [
            ColumnSpec("rows_read", "number", c("rows_read") < 0),
            ColumnSpec("rows_rejected", "number", outside("rows_rejected", 50_000_000) | above("rows_rejected", "rows_read")),
            ColumnSpec("layer", "category"),
            run_id,
        ],
    }


def value_count_store(spark: SparkSession, sf: str, compact: bool = True) -> profile.ValueCountStore:
    """The value counts of both tables: one signed delta with the loads before the newest, one with the newest."""
    store = profile.ValueCountStore(spark, new_path(spark, "value-counts"))
    rows = {name: table(spark, sf, name) for name in _specs()}
    newest = {name: df.agg(F.max("load_no")).first()[0] for name, df in rows.items()}
    last = lambda name: F.coalesce(F.col("load_no") == F.lit(newest[name]), F.lit(False))
    for late in (False, True):
        store.apply_deltas([profile.value_counts(df.filter(last(name) if late else ~last(name)), name, "load_no", _specs()[name]) for name, df in rows.items()])
    if compact:
        store.compact()
    return store


CATEGORIES = ["layer", "severity"]
_PROFILE = ["n_rows", "nulls", "n_distinct", "min_value", "max_value"]


def _shown(figures: DataFrame, *more: str) -> DataFrame:
    rounded = [F.round("median", 3).alias("median"), *(F.round(c, 6).alias(c) for c in more), F.round("entropy", 6).alias("entropy")]
    return figures.select(F.col("scope").alias("table_name"), *([F.col("load").alias("load_no")] if "load" in figures.columns else []), "column_name", *_PROFILE, *rounded)


def p1_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Every considered column of every load: nulls, distinct values, range, median, zeros, broken forms and entropy."""
    return _shown(profile.load_profile(value_count_store(spark, sf).maintained()), "null_share", "broken_share", "zero_share")


def p1_state(spark: SparkSession, sf: str) -> DataFrame:
    """The same figures of the tables as they are after all loads."""
    return _shown(profile.state_profile(value_count_store(spark, sf, compact=False).table.read()))


def p1_withdrawn(spark: SparkSession, sf: str) -> DataFrame:
    """The state after the newest load of each table was withdrawn again: a negative delta made from the stored counts."""
    store = value_count_store(spark, sf, compact=False)
    for name in _specs():
        store.withdraw(name, [table(spark, sf, name).agg(F.max("load_no")).first()[0]])
    return _shown(profile.state_profile(store.table.read()).filter("n_rows > 0"))


def p1_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of columns that aren't whole numbers: doubles (with negative ones), decimals, dates and times."""
    store = profile.ValueCountStore(spark, new_path(spark, "value-counts"))
    lines = table(spark, sf, "lineitem").select(
        F.lit(1).alias("load"), "l_discount", (F.col("l_extendedprice") - 30_000).alias("margin"), F.col("l_extendedprice").cast("decimal(12,2)").alias("price"), F.to_date("l_shipdate").alias("ship_day"), "l_shipdate"
    )
    store.apply(lines, "lineitem", "load", [ColumnSpec(c, "number") for c in lines.columns if c != "load"])
    return _shown(profile.load_profile(store.counts())).drop("load_no")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    counts = value_count_store(spark, sf).maintained()
    figures = materialise(profile.load_profile(counts), "profiles")
    return profile.departures(counts, figures, CATEGORIES).select(F.col("scope").alias("table_name"), F.col("load").alias("load_no"), "column_name")


# -- 2: attributes as known at event time -----------------------------------------------------


def named_micros(df: DataFrame, name: Column, columns: list[str]) -> Column:
    """The microseconds of the column that ``name`` names: bigint columns hold seconds; null beyond the range of a bigint."""
    kinds = dict(df.dtypes)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp")) if kinds[c].startswith("timestamp") else F.try_multiply(F.col(c).cast("bigint"), F.lit(1_000_000))
    return F.create_map(*(x for c in columns for x in (F.lit(c), micros(c))))[name]


ORDER_TIMES = ["purchased_at", "delivered_at", "updated_at", "arrived_at"]


def orders_with_event_time(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "shop_orders")
    objects = table(spark, sf, "source_object").select(F.col("id").alias("source_object_id"), F.trim("incremental_column").alias("_time")).dropDuplicates(["source_object_id"])
    return orders.join(objects, "source_object_id").withColumn("event_us", named_micros(orders, F.col("_time"), ORDER_TIMES)).drop("_time")


def _as_of(spark: SparkSession, sf: str) -> dict:
    orders = orders_with_event_time(spark, sf).select("row_no", strip("customer_id").alias("customer_id"), "event_us", F.unix_micros("arrived_at").alias("arrived_us"))
    history = table(spark, sf, "customer_history").withColumn("customer_id", strip("customer_id"))
    return {"events": orders, "versions": history, "key": "customer_id", "event_time": "event_us", "valid_from": "valid_from", "recorded_at": "ingested_at", "version": "version_no", "deleted": "is_deleted"}


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return asof.attributes_at_event(**_as_of(spark, sf)).select("row_no", "version_no")


def p2_as_known(spark: SparkSession, sf: str) -> DataFrame:
    """The version valid at each row's event time as it was known when the row arrived: points off the diagonal of the plane."""
    return asof.attributes_at_event(**_as_of(spark, sf), known_at="arrived_us").select("row_no", "version_no")


def p2_cells(spark: SparkSession, sf: str) -> DataFrame:
    """How many cells of the index hold how many versions and rectangles."""
    return asof.cell_sizes(**_as_of(spark, sf), known_at="arrived_us").groupBy("versions", "rectangles").agg(F.count("*").alias("cells"))


# -- 3 and 6: snapshots -----------------------------------------------------------------------


def _snapshots(spark: SparkSession, sf: str) -> dict:
    objects = table(spark, sf, "source_object").select(F.col("id").alias("source_object_id"), (F.lower(F.trim("load_strategy")) == "incremental").alias("incremental")).dropDuplicates(["source_object_id"])
    compared = [F.col("customer_email"), F.col("customer_phone"), strip("customer_city"), F.col("customer_state"), F.col("customer_zip_prefix")]
    return {
        "rows": table(spark, sf, "customer_snapshots"), "objects": objects, "obj": "source_object_id", "number": "snapshot_no", "taken_at": "taken_at",
        "key": "customer_id", "updated_at": "updated_at", "compared": compared,
    }


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return snapdiff.snapshot_changes(**_snapshots(spark, sf), values=["customer_id"]).select("source_object_id", "snapshot_no", "customer_id", "change_type")


def p3_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Added, removed, changed and unchanged customers of each snapshot after an object's first."""
    cases = p3_found(spark, sf).groupBy("source_object_id", "snapshot_no").agg(*(F.count_if(F.col("change_type") == c).alias(f"n_{c}") for c in ("added", "removed", "changed")))
    s = _snapshots(spark, sf)
    order = snapdiff.ordered_snapshots(s["rows"], s["obj"], s["number"], s["taken_at"]).filter("rank > 1")
    held = s["rows"].groupBy("source_object_id", "snapshot_no").agg(F.countDistinct(F.struct("customer_id")).alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return order.join(held, ["source_object_id", "snapshot_no"]).join(cases, ["source_object_id", "snapshot_no"], "left").select(
        "source_object_id", "snapshot_no", zero("n_added"), zero("n_removed"), zero("n_changed"), (F.col("n") - F.coalesce("n_added", F.lit(0)) - F.coalesce("n_changed", F.lit(0))).alias("n_unchanged")
    )


def _history(spark: SparkSession, sf: str, carried: list[str] | None = None) -> merkle.MerkleHistory:
    """The snapshots as they come: in one run all but each object's last one, in the next the last, which is compared with the stored trees."""
    s = _snapshots(spark, sf)
    rows, objects = s.pop("rows"), s.pop("objects")
    order = snapdiff.ordered_snapshots(rows, s["obj"], s["number"], s["taken_at"])
    order = materialise(order.select(s["obj"], s["number"], (F.col("rank") < F.greatest("last", F.lit(2))).alias("_early")), "snapshot-order")
    early = rows.join(order.filter("_early").select(s["obj"], s["number"]), [s["obj"], s["number"]], "left_semi")
    late = rows.join(order.filter("not _early").select(s["obj"], s["number"]), [s["obj"], s["number"]], "left_semi")
    out = merkle.MerkleHistory(spark, new_path(spark, "history"), **s, carried=carried)
    out.add(early, objects)
    out.add(late, objects)
    return out


ATTRIBUTES = ["customer_email", "customer_phone", "customer_city", "customer_state", "customer_zip_prefix"]


def p6_history(spark: SparkSession, sf: str) -> DataFrame:
    """The full history with its periods and attributes."""
    out = _history(spark, sf, ATTRIBUTES).read()
    return out.withColumns({"from_us": F.unix_micros("valid_from"), "to_us": F.unix_micros("valid_to")}).drop("valid_from", "valid_to")


def p6_runs(spark: SparkSession, sf: str) -> DataFrame:
    """What each run compared and touched: leaves of its snapshots, leaves that differ, bytes of versions read and left alone."""
    runs = _history(spark, sf).versions.history()
    return spark.createDataFrame([(m.version, *(m.metrics[c] for c in ("leaves", "changed", "read_bytes", "kept_bytes"))) for m in runs], "run bigint, leaves bigint, changed bigint, read_bytes bigint, kept_bytes bigint")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf).read().select("source_object_id", "customer_id", "from_snapshot", "to_snapshot", F.col("is_deleted").cast("bigint").alias("deleted"))


# -- 4: schema drift --------------------------------------------------------------------------


def _drift(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return schemadrift.full_drift(
        table(spark, sf, "schema_version"), table(spark, sf, "landed_rows"), obj="source_object_id", version="version", schema="schema_json", payload="payload", key="record_key", captured_at="captured_at"
    )


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    edits = _drift(spark, sf)[2]
    return edits.filter(F.col("change_type").isin("added", "removed", "renamed", "retyped")).select(F.col("object").alias("source_object_id"), "version", "change_type", "column_name").distinct()


def p4_unified(spark: SparkSession, sf: str) -> DataFrame:
    """All records of all objects under the names of their newest schema; ``typed_table`` gives one object's table with typed columns."""
    pairs, read, edits = _drift(spark, sf)
    out = schemadrift.unified(read, schemadrift.projections(pairs, edits))
    return out.select(F.col("object").alias("source_object_id"), "version", "record_key", F.to_json("fields").alias("fields"))


def p4_values(spark: SparkSession, sf: str) -> DataFrame:
    """The same records value by value."""
    pairs, read, edits = _drift(spark, sf)
    out = schemadrift.unified(read, schemadrift.projections(pairs, edits))
    return out.select(F.col("object").alias("source_object_id"), "version", "record_key", F.explode("fields").alias("column_name", "value"))


# -- 5: change feed ---------------------------------------------------------------------------


def change_table(spark: SparkSession, sf: str) -> BucketedTable:
    """The feeds as they come: all that arrived in the first nine tenths of the time in one batch, then the late changes in two, first those of the feeds in the first half of the load order."""
    changes = table(spark, sf, "customer_changes")
    objects = table(spark, sf, "source_object").select(F.col("id").alias("object"), "primary_key_columns", "cdc_operation_column", "cdc_delete_value", "incremental_column", "load_order").dropDuplicates(["object"])
    out = BucketedTable(spark, new_path(spark, "current"))
    edge = changes.agg(F.min("arrived_at").alias("a"), F.max("arrived_at").alias("b")).first()
    cut = lambda c, o: normalised(c, o, obj="source_object_id", number="change_no", arrived_at="arrived_at")
    if edge.a is None:
        out.apply(cut(changes, objects))
        return out
    late = F.coalesce(F.col("arrived_at") > F.lit(edge.a + (edge.b - edge.a) * 0.9), F.lit(True))
    feeds = objects.join(changes.select(F.col("source_object_id").alias("object")).distinct(), "object", "left_semi")
    middle = feeds.agg(F.percentile_approx("load_order", 0.5)).first()[0]
    soon = F.coalesce(F.col("load_order") <= F.lit(middle), F.lit(False))
    out.apply(cut(changes.filter(~late), objects))
    out.apply(cut(changes.filter(late), objects.filter(soon)))
    out.apply(cut(changes.filter(late), objects.filter(~soon)))
    return out


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return change_table(spark, sf).current().select(F.col("object").alias("source_object_id"), "change_no")


def p5_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """What each batch wrote anew and what it left alone, in buckets."""
    history = change_table(spark, sf).table.history()
    return spark.createDataFrame([(m.version, m.metrics["touched"], m.metrics["kept"]) for m in history], "batch bigint, touched bigint, kept bigint")


def p5_current(spark: SparkSession, sf: str) -> DataFrame:
    """The current rows of every object."""
    return change_table(spark, sf).current().select(F.col("object").alias("source_object_id"), "change_no", "payload.customer_id", "payload.customer_state", "payload.customer_city", "payload.customer_zip_prefix")


# -- 7: only new or changed records -----------------------------------------------------------


def new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of shop_orders that are no repeats, kept up to date partition by partition: by object and week of the row's update time, which repeats share."""
    orders = table(spark, sf, "shop_orders")
    result = increment.IncrementalResult(spark, new_path(spark, "new-rows"))
    week = F.floor(F.col("updated_at") / (7 * 86400))
    partition = F.concat_ws("-", F.coalesce(F.col("source_object_id").cast("string"), F.lit("none")), F.coalesce(week.cast("string"), F.lit("none")))
    form = lambda c: strip(c) if c == "customer_id" else F.col(c)

    def compute(rows: DataFrame) -> DataFrame:
        return increment.first_of_repeats(rows, ignored=["row_no", "arrived_at"], order=["arrived_at", "row_no"], trimmed=form).select("row_no", "source_object_id", "arrived_at", increment.PART)

    edge = orders.agg(F.min("arrived_at").alias("a"), F.max("arrived_at").alias("b")).first()
    if edge.a is not None:  # an earlier run, after which late and new rows change some partitions
        result.run(orders.filter(F.col("arrived_at") <= F.lit(edge.a + (edge.b - edge.a) * 0.9)), partition, compute)
    result.run(orders, partition, compute)
    return result.read() if result.marks.exists() else orders.select("row_no", "source_object_id", "arrived_at")


def _succeeded(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "incremental_runs").filter((F.col("status") == "succeeded") & F.col("started_at").isNotNull())
    return runs.select("run_no", "source_object_id", "started_at").distinct()


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = new_rows(spark, sf).filter("arrived_at is not null")
    return increment.first_run_after(rows, _succeeded(spark, sf), obj="source_object_id", arrived="arrived_at", started="started_at", run="run_no").select("run_no", "row_no")


def p7_runs(spark: SparkSession, sf: str) -> DataFrame:
    """What each successful run's log should say: its watermarks in seconds, the rows it was the first to read and those its grace window read again."""
    settings = table(spark, sf, "source_object").select(F.col("id").alias("source_object_id"), (F.col("watermark_grace") * 1_000_000).alias("grace")).dropDuplicates(["source_object_id"])
    runs = _succeeded(spark, sf).join(settings, "source_object_id")
    out = increment.run_watermarks(orders_with_event_time(spark, sf), runs, obj="source_object_id", arrived="arrived_at", started="started_at", run="run_no", value="event_us", grace="grace")
    seconds = lambda c: F.expr(f"{c} div 1000000").alias(c)
    return out.select("source_object_id", "run_no", seconds("watermark_from"), seconds("watermark_to"), "rows_new", "rows_reprocessed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_profile, p1_state, p1_withdrawn, p1_prices, p2_found, p2_as_known, p2_cells, p3_found, p3_counts, p4_found, p4_unified, p4_values, p5_found, p5_buckets, p5_current, p6_found, p6_history, p6_runs, p7_found, p7_runs)
}
