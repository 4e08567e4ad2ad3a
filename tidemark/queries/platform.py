"""Queries of the platform's own behaviour: sources, drift, contracts, severities, histories, privacy, runs, maintenance and lineage. Where an answer is fixed, its SQL states it."""

from __future__ import annotations

import json
import logging
import os
import tempfile
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.control import contracts, drift
from tidemark.control.store import DIALECTS, ControlStore, ddl
from tidemark.functions.names import require_columns
from tidemark.operators import privacy, quality, scd2
from tidemark.plans import audit, bronze, classify, gold, replay, runner, silver
from tidemark.plans.bronze import Lake
from tidemark.plans.lineage import Lineage
from tidemark.queries.core import _BROKEN, _SCD2_BATCH, _T1, _T2, _history, _marked, _pad_sql, at, one_object, query, shop_lake, us
from tidemark.runtime import new_path, session_settings
from tidemark.settings import JsonFormatter, Settings
from tidemark.sources.seed import Seed
from tidemark.sources.source import FilteringSource, FrameSource, ParquetSource
from tidemark.sources.tables import table
from tidemark.storage import maintenance
from tidemark.storage.table import VersionedTable
from tidemark.streaming import ingest


def frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def values(columns: str, *rows: tuple) -> str:
    """SQL of fixed rows."""
    shown = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(shown, r)) + ')' for r in rows)}) t({columns})"


# -- sources ----------------------------------------------------------------------------------


@query("SELECT count(*) AS n FROM customer")
def source_parquet(spark: SparkSession, sf: str) -> DataFrame:
    _, obj, _ = one_object(spark, "customer", "full", "c_custkey")
    return frame(spark, [(bronze.row_count(ParquetSource(spark, sf).read(obj)),)], "n bigint")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def source_filtering(spark: SparkSession, sf: str) -> DataFrame:
    _, obj, _ = one_object(spark, "orders", "incremental", "o_orderkey", "o_orderdate")
    return FilteringSource(ParquetSource(spark, sf)).read_since(obj, at("1998-01-01")).select("o_orderkey")


@query(values("name, n", ("customers", 500), ("products", 50), ("sellers", 10), ("orders", 2500), ("order_items", 5000), ("items without order", 0), ("orders without customer", 0)))
def seed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct keys of the seeded tables and references that lead nowhere."""
    seed = Seed(spark, 5000)
    t = {n: seed.table(n) for n in seed.sizes}
    keys = {"customers": "customer_id", "products": "product_id", "sellers": "seller_id", "orders": "order_id", "order_items": "order_item_id"}
    counts = [(n, t[n].select(k).distinct().count()) for n, k in keys.items()]
    lost = [("items without order", t["order_items"].join(t["orders"], "order_id", "left_anti").count()), ("orders without customer", t["orders"].join(t["customers"], "customer_id", "left_anti").count())]
    return frame(spark, counts + lost, "name string, n bigint")


@query(values("run_id", ("run-2",)))
def bronze_latest_run(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, _ = one_object(spark, "region", "full", "r_regionkey")
    for run in ("run-1", "run-2"):
        lake.store.insert("pipeline_run", run_id=run, pipeline_name="query", status="running", started_at="2024-01-01T00:00:00+00:00")
        bronze.full_load(lake, ParquetSource(spark, sf), obj, run)
    return frame(spark, [(bronze.latest_run_id(lake.table(obj.target_path).read()),)], "run_id string")


@query("SELECT event_id, n FROM (SELECT event_id, count(*) AS n FROM (SELECT event_id FROM events UNION ALL SELECT event_id FROM events) GROUP BY 1)")
def stream_two(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams with their own checkpoints into one table; the first is started again and has nothing to add."""
    events = table(spark, sf, "events")
    out = VersionedTable(spark, new_path(spark, "streamed"))
    marks = [new_path(spark, "stream-state"), new_path(spark, "stream-state")]
    for mark in (*marks, marks[0]):
        ingest.append_stream(ingest.parquet_stream(spark, f"{sf}/event[s].parquet", events.schema), out, mark).awaitTermination()
    return out.read().groupBy("event_id").agg(F.count("*").alias("n"))


# -- drift and contracts ----------------------------------------------------------------------


@query(values("change, same", ("order of columns", True), ("nullable", False), ("a type", False)))
def drift_hash(spark: SparkSession, sf: str) -> DataFrame:
    columns = drift.describe(table(spark, sf, "orders"))
    other = {"order of columns": columns[::-1], "nullable": [{**columns[0], "nullable": not columns[0]["nullable"]}, *columns[1:]], "a type": [{**columns[0], "type": "string"}, *columns[1:]]}
    return frame(spark, [(k, drift.schema_hash(v) == drift.schema_hash(columns)) for k, v in other.items()], "change string, same boolean")


@query(values("step, outcome, schema_version", ("first", "loaded", 1), ("same", "loaded", 1), ("wider", "loaded", 2), ("narrower", "SchemaDriftError", 2), ("retyped", "SchemaDriftError", 2)))
def drift_policy(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, run = one_object(spark, "nation", "full", "n_nationkey")
    base = table(spark, sf, "nation")
    wide = base.withColumn("extra", F.lit("x"))
    out = []
    for step, df in (("first", base), ("same", base), ("wider", wide), ("narrower", base), ("retyped", wide.withColumn("n_regionkey", F.col("n_regionkey").cast("string")))):
        try:
            bronze.full_load(lake, FrameSource({"nation": df}), obj, run)
            outcome = "loaded"
        except drift.SchemaDriftError as e:
            outcome = type(e).__name__
        out.append((step, outcome, lake.store.one("SELECT version FROM schema_version WHERE is_current = 1")["version"]))
    return frame(spark, out, "step string, outcome string, schema_version bigint")


CONTRACT = """
version: 1
source_system: driver
object: lineitem
owner: sales
columns:
  - {name: l_orderkey, type: int64, nullable: false}
  - {name: l_quantity, type: double, expect: {minimum: 2, maximum: 48, severity: quarantine}}
  - {name: l_returnflag, type: string, expect: {allowed_values: [A, N], severity: warn}}
  - {name: l_linestatus, type: large_string, expect: {pattern: "^[F]$", severity: warn}}
  - {name: l_comment, type: string}
"""


def _contract(lake: Lake) -> contracts.Contract:
    with tempfile.TemporaryDirectory() as folder:  # configuration that only the driver reads
        (Path(folder) / "sales").mkdir()
        (Path(folder) / "sales" / "lineitem.yml").write_text(CONTRACT)
        found = contracts.load(folder)
    contracts.sync(lake.store, found[0])
    return found[0]


@query(values("rule_type, column_name, severity", ("unique", "by_hand", "warn"), ("not_null", "l_orderkey", "fail"), ("range", "l_quantity", "quarantine"), ("allowed_values", "l_returnflag", "warn"), ("regex", "l_linestatus", "warn")))
def contract_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A contract in a subfolder, synchronised twice; a rule made by hand stays."""
    lake, obj, _ = one_object(spark, "lineitem", "full", "l_orderkey")
    lake.store.insert("dq_rule", source_object_id=obj.id, rule_type="unique", severity="warn", column_name="by_hand")
    _contract(lake)
    _contract(lake)
    return frame(spark, [(r["rule_type"], r["column_name"], r["severity"]) for r in lake.store.rows("SELECT * FROM dq_rule")], "rule_type string, column_name string, severity string")


@query(values("message", ("l_comment is missing",), ("l_quantity is string, not double",)))
def contract_conformance(spark: SparkSession, sf: str) -> DataFrame:
    lake, _, _ = one_object(spark, "lineitem", "full", "l_orderkey")
    found = contracts.conformance(_contract(lake), table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("string")))
    return frame(spark, [(m,) for m in found], "message string")


@query(
    f"""WITH {_BROKEN} SELECT unnest(['not_null', 'range', 'allowed_values', 'regex']) AS rule_type, unnest([count(*) FILTER (r1), count(*) FILTER (r2), count(*) FILTER (r3), count(*) FILTER (r4)])::BIGINT AS failed_rows FROM m"""
)
def contract_evaluated(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, _ = one_object(spark, "lineitem", "full", "l_orderkey")
    _contract(lake)
    report = quality.evaluate(table(spark, sf, "lineitem"), silver.rules_of(lake, obj))
    return frame(spark, [(r.rule.rule_type, r.failed_rows) for r in report.results], "rule_type string, failed_rows bigint")


@query(values("message", ("orders: missing column(s) nope, nowhere",)))
def require_missing(spark: SparkSession, sf: str) -> DataFrame:
    try:
        require_columns(table(spark, sf, "orders"), ["o_orderkey", "nope", "nowhere"], "orders")
    except KeyError as e:
        return frame(spark, [(e.args[0],)], "message string")
    raise AssertionError


# -- quality ----------------------------------------------------------------------------------

_AGES = (60, 10_000_000)


@query(" UNION ALL ".join(f"SELECT {m}::BIGINT AS max_age_minutes, epoch_us(TIMESTAMP '2000-01-01') - epoch_us(max(o_orderdate)) <= {m}::BIGINT * 60000000 AS passed FROM orders" for m in _AGES))
def quality_freshness(spark: SparkSession, sf: str) -> DataFrame:
    rules = [quality.Rule(i, "freshness", "warn", "o_orderdate", json.dumps({"max_age_minutes": m})) for i, m in enumerate(_AGES)]
    found = quality.evaluate(table(spark, sf, "orders"), rules, at("2000-01-01").timestamp()).results
    return frame(spark, [(m, r.passed) for m, r in zip(_AGES, found, strict=True)], "max_age_minutes bigint, passed boolean")


@query(values("case_name, refused", ("custom_sql", True), ("unknown type", True), ("range without bounds", True), ("null bounds", True), ("bad pattern", True), ("no such column", True), ("one null bound", False), ("pattern of Java", False)))
def quality_refused(spark: SparkSession, sf: str) -> DataFrame:
    rule = lambda kind, column="o_orderstatus", **p: quality.Rule(1, kind, "warn", column, json.dumps(p))
    cases = {
        "custom_sql": rule("custom_sql"), "unknown type": rule("nope"), "range without bounds": rule("range", "o_totalprice"), "null bounds": rule("row_count", None, minimum=None, maximum=None), "bad pattern": rule("regex", pattern="["),
        "no such column": rule("not_null", "absent"), "one null bound": rule("row_count", None, minimum=1, maximum=None), "pattern of Java": rule("regex", pattern=r"\p{Upper}++"),
    }
    out = []
    for name, r in cases.items():
        try:
            quality.evaluate(table(spark, sf, "orders"), [r])
            out.append((name, False))
        except quality.RuleError:
            out.append((name, True))
    return frame(spark, out, "case_name string, refused boolean")


@query("SELECT 'range' AS rule_type, false AS passed, count(*) FILTER (o_totalprice < 50000) AS failed_rows, 'failed' AS task_status, false AS written FROM orders UNION ALL SELECT 'not_null', true, 0, 'failed', false")
def quality_fail(spark: SparkSession, sf: str) -> DataFrame:
    """A broken rule of severity fail: all results are recorded, nothing is written."""
    lake, obj, run = one_object(spark, "orders", "full", "o_orderkey")
    lake.store.insert("dq_rule", source_object_id=obj.id, rule_type="range", column_name="o_totalprice", severity="fail", expression=json.dumps({"minimum": 50_000}))
    lake.store.insert("dq_rule", source_object_id=obj.id, rule_type="not_null", column_name="o_orderkey", severity="warn")
    bronze.full_load(lake, FrameSource({"orders": table(spark, sf, "orders")}), obj, run)
    try:
        silver.build(lake, obj, run)
    except quality.QualityFailure:
        pass
    task = lake.store.one("SELECT status FROM task_run WHERE layer = 'silver'")["status"]
    found = lake.store.rows("SELECT r.rule_type, d.passed, d.failed_row_count FROM dq_result d JOIN dq_rule r ON r.id = d.dq_rule_id")
    written = lake.table("silver/orders").exists()
    return frame(spark, [(r["rule_type"], bool(r["passed"]), r["failed_row_count"], task, written) for r in found], "rule_type string, passed boolean, failed_rows bigint, task_status string, written boolean")


# -- history ----------------------------------------------------------------------------------


def _third(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A third batch with all first keys: deleted ones come back, some changes are late, the keys of the second batch alone are gone."""
    history = scd2.rewritten(*_marked(spark, sf))
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(k % 13 == 0, "LATE").when(k % 7 == 0, "CHANGED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), F.when(k % 13 == 0, F.lit(at(_T1))).alias("changed_at")
    )
    effective = scd2.effective_time(rows, "changed_at", F.lit(at("2024-03-01")))
    stamped = rows.withColumn("__start", effective)
    return history, scd2.classified(history, stamped.drop("changed_at", "__start"), ["c_custkey"], F.when(k % 13 == 0, F.lit(at(_T1))).otherwise(F.lit(at("2024-03-01"))), F.lit(at("2024-03-01")), tombstones=True)


_THIRD = """SELECT CASE WHEN c_custkey % 11 = 0 THEN 'reopen' WHEN c_custkey % 13 = 0 THEN 'late' ELSE 'unchanged' END AS action, count(*) AS n FROM customer GROUP BY 1
UNION ALL SELECT 'tombstone', count(*) FROM customer WHERE c_custkey % 100 = 1 HAVING count(*) > 0"""


@query(_THIRD)
def scd2_third_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _third(spark, sf)[1].groupBy("action").agg(F.count("*").alias("n"))


@query(
    f"""WITH a AS ({_THIRD}) SELECT coalesce(sum(n) FILTER (action IN ('reopen', 'tombstone')), 0)::BIGINT AS opened, coalesce(sum(n) FILTER (action IN ('reopen', 'tombstone')), 0)::BIGINT AS closed, coalesce(sum(n) FILTER (action = 'tombstone'), 0)::BIGINT AS tombstoned,
    coalesce(sum(n) FILTER (action = 'unchanged'), 0)::BIGINT AS unchanged, coalesce(sum(n) FILTER (action = 'late'), 0)::BIGINT AS late_skipped FROM a"""
)
def scd2_outcome(spark: SparkSession, sf: str) -> DataFrame:
    o = scd2.outcome(_third(spark, sf)[1])
    return frame(spark, [(o.opened, o.closed, o.tombstoned, o.unchanged, o.late_skipped)], "opened bigint, closed bigint, tombstoned bigint, unchanged bigint, late_skipped bigint")


@query("SELECT o_orderkey, epoch_us(CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2024-01-01' ELSE o_orderdate END) AS effective_us FROM orders")
def scd2_effective(spark: SparkSession, sf: str) -> DataFrame:
    """A row's own time where it has one, else the run's."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    return rows.select("o_orderkey", us(scd2.effective_time(rows, "o_orderdate", F.lit(at("2024-01-01")))).alias("effective_us"))


@query(values("message", ("history and batch differ: added ['extra'], removed ['c_mktsegment']",)))
def scd2_guard(spark: SparkSession, sf: str) -> DataFrame:
    first, _ = _history(spark, sf)
    try:
        scd2.guard_schema(scd2.with_history(first, ["c_custkey"], F.lit(at(_T1))), first.drop("c_mktsegment").withColumn("extra", F.lit(1)))
    except ValueError as e:
        return frame(spark, [(str(e),)], "message string")
    raise AssertionError


@query(
    f"""WITH {_SCD2_BATCH}, t AS (SELECT epoch_us(TIMESTAMP '{_T1}') AS t1, epoch_us(TIMESTAMP '{_T2}') AS t2)
    SELECT c.c_custkey, c.c_mktsegment, t1 AS from_us, CASE WHEN b.c_custkey IS NULL OR b.c_mktsegment <> c.c_mktsegment THEN t2 END AS to_us, false AS is_deleted FROM customer c LEFT JOIN b USING (c_custkey), t
    UNION ALL SELECT b.c_custkey, b.c_mktsegment, t2, NULL, false FROM b LEFT JOIN customer c USING (c_custkey), t WHERE c.c_custkey IS NULL OR b.c_mktsegment <> c.c_mktsegment
    UNION ALL SELECT c.c_custkey, c.c_mktsegment, t2, NULL, true FROM customer c LEFT JOIN b USING (c_custkey), t WHERE b.c_custkey IS NULL"""
)
def silver_history(spark: SparkSession, sf: str) -> DataFrame:
    """Two full loads through bronze and silver: the first batch opens all, the second is merged into the key buckets."""
    lake, obj, run = one_object(spark, "customer", "full", "c_custkey", scd2_enabled=1)
    for rows, moment in zip(_history(spark, sf), (_T1, _T2), strict=True):
        bronze.full_load(lake, FrameSource({"customer": rows}), obj, run)
        silver.build(lake, obj, run, at(moment))
    return lake.table("silver/customer").read().select("c_custkey", "c_mktsegment", us("valid_from").alias("from_us"), us("valid_to").alias("to_us"), "is_deleted")


# -- privacy ----------------------------------------------------------------------------------


@query(values("column_name", ("customer_key",), ("c_custkey",), ("c_nationkey",), ("c_mktsegment",)))
def gold_restricted(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension without the columns that aren't allowed in gold."""
    lake, obj, run = one_object(spark, "customer", "full", "c_custkey")
    lake.store.update("source_object", {"id": obj.id}, gold_role="dimension")
    obj = lake.store.object(obj.id)
    for column in ("c_name", "c_acctbal"):
        lake.store.insert("column_metadata", source_object_id=obj.id, column_name=column, sensitivity="sensitive_pii", masking_strategy="redact")
    bronze.full_load(lake, FrameSource({"customer": table(spark, sf, "customer")}), obj, run)
    silver.build(lake, obj, run)
    gold.build(lake, obj, run)
    columns = [c for c in lake.table("gold/dim_customer").read().columns if c not in ("ingested_at", "run_id", "source")]
    return frame(spark, [(c,) for c in columns], "column_name string")


@query(values("column_name, sensitivity, masking", ("by_hand", "internal", "none"), ("customer_email", "pii", "hash"), ("customer_phone", "pii", "partial"), ("customer_city", "internal", "none"), ("customer_zip_prefix", "internal", "none")))
def privacy_applied(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, _ = one_object(spark, "customers", "full", "customer_id")
    lake.store.insert("column_metadata", source_object_id=obj.id, column_name="by_hand", sensitivity="internal", masking_strategy="none")
    rows = table(spark, sf, "customer_snapshots").select("customer_id", "customer_email", "customer_phone", "customer_city", "customer_zip_prefix")
    for _ in range(2):
        classify.apply_proposals(lake.store, obj, [*privacy.scan(rows), privacy.Proposal("by_hand", "pii", "hash", "a guess")])
    return frame(spark, [(r["column_name"], r["sensitivity"], r["masking_strategy"]) for r in lake.store.rows("SELECT * FROM column_metadata")], "column_name string, sensitivity string, masking string")


@query(values("environment, secret, outcome", ("development", None, "development key"), ("production", None, "refused"), ("production", "TIDEMARK_QUERY_SECRET", "from the environment")))
def privacy_key(spark: SparkSession, sf: str) -> DataFrame:
    out = []
    os.environ["TIDEMARK_QUERY_SECRET"] = "s3cret"
    for environment, secret in (("development", None), ("production", None), ("production", "TIDEMARK_QUERY_SECRET")):
        try:
            key = privacy.masking_key(secret, environment)
            out.append((environment, secret, "from the environment" if key == b"s3cret" else "development key"))
        except KeyError:
            out.append((environment, secret, "refused"))
    del os.environ["TIDEMARK_QUERY_SECRET"]
    return frame(spark, out, "environment string, secret string, outcome string")


@query(f"SELECT c_custkey, substr(sha256({_pad_sql(0x5C, privacy.DEV_KEY)} || unhex(sha256({_pad_sql(0x36, privacy.DEV_KEY)} || encode(c_name)))), 1, 32) AS c_name FROM customer WHERE c_custkey % 2 = 0")
def privacy_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rules see values, the table only masks: names that end in an odd digit are quarantined by a rule on the plain name."""
    lake, obj, run = one_object(spark, "customer", "full", "c_custkey")
    lake.store.insert("column_metadata", source_object_id=obj.id, column_name="c_name", sensitivity="pii", masking_strategy="hash")
    rows = table(spark, sf, "customer").withColumn("plain", F.col("c_custkey").cast("string"))
    lake.store.insert("dq_rule", source_object_id=obj.id, rule_type="regex", column_name="plain", severity="quarantine", expression=json.dumps({"pattern": "[02468]$"}))
    lake.store.insert("column_metadata", source_object_id=obj.id, column_name="plain", sensitivity="pii", masking_strategy="redact")
    bronze.full_load(lake, FrameSource({"customer": rows}), obj, run)
    silver.build(lake, obj, run)
    return lake.table("silver/customer").read().filter("plain is null").select("c_custkey", "c_name")


# -- runs and audit ---------------------------------------------------------------------------


@query("SELECT 'customer' AS object_name, 'bronze' AS layer, 'succeeded' AS status, (SELECT count(*) FROM customer) AS rows_written UNION ALL SELECT 'orders', 'bronze', 'succeeded', (SELECT count(*) FROM orders) UNION ALL SELECT 'customer', 'silver', 'succeeded', (SELECT count(*) FROM customer) UNION ALL SELECT 'orders', 'silver', 'succeeded', (SELECT count(*) FROM orders) UNION ALL SELECT 'customer', 'gold', 'succeeded', (SELECT count(*) + 1 FROM customer) UNION ALL SELECT 'orders', 'gold', 'succeeded', (SELECT count(*) FROM orders) UNION ALL SELECT 'all again', '', 'skipped', 6")
def pipeline_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a run over all layers, and of the same run resumed."""
    lake = shop_lake(spark, sf)
    run = lake.store.one("SELECT run_id FROM pipeline_run WHERE pipeline_name = 'pipeline'")["run_id"]
    found = lake.store.rows("SELECT o.object_name, t.layer, t.status, t.rows_written FROM task_run t JOIN source_object o ON o.id = t.source_object_id WHERE t.run_id = ?", run)
    again = runner.run_pipeline(lake, FrameSource({}), run_id=run)
    rows = [(r["object_name"], r["layer"], r["status"], r["rows_written"]) for r in found] + [("all again", "", *{s.status for s in again.steps}, len(again.steps))]
    return frame(spark, rows, "object_name string, layer string, status string, rows_written bigint")


@query(values("case_name, run_status, task_status, error", ("good", "succeeded", "succeeded", None), ("bad", "failed", "failed", "OSError: lost"), ("open", "running", None, None)))
def track_runs(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, _ = one_object(spark, "region", "full", "r_regionkey")
    store, out = lake.store, []
    with store.run("good", run_id="good") as run, store.task(run, obj, "bronze") as task:
        task.update(rows_read=1)
    try:
        with store.run("bad", run_id="bad") as run, store.task(run, obj, "bronze"):
            raise OSError("lost")
    except OSError:
        pass
    store.insert("pipeline_run", run_id="open", pipeline_name="open", status="running", started_at="2024-01-01T00:00:00+00:00")
    for name in ("good", "bad", "open"):
        task = store.one("SELECT * FROM task_run WHERE run_id = ?", name) or {}
        out.append((name, store.one("SELECT status FROM pipeline_run WHERE run_id = ?", name)["status"], task.get("status"), task.get("error_message")))
    return frame(spark, out, "case_name string, run_status string, task_status string, error string")


def _stale(spark: SparkSession) -> ControlStore:
    lake, obj, _ = one_object(spark, "region", "full", "r_regionkey")
    store = lake.store
    for run in ("stuck", "half done"):
        store.insert("pipeline_run", run_id=run, pipeline_name="x", status="running", started_at="2020-01-01T00:00:00+00:00")
    store.insert("task_run", run_id="half done", source_object_id=obj.id, layer="bronze", status="quarantined", started_at="2020-01-01T00:00:00+00:00", ended_at="2020-01-01T01:00:00+00:00")
    store.insert("pipeline_run", run_id="fresh", pipeline_name="x", status="running", started_at=datetime.now(UTC).isoformat())
    store.update("pipeline_run", {"run_id": "r"}, status="succeeded")
    return store


@query(values("run_id, status, ended_at", ("stuck", "failed", "2020-01-01 00:00:00"), ("half done", "quarantined", "2020-01-01 01:00:00"), ("fresh", "running", None)))
def audit_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Runs left behind are closed: at the end of their last task, or at their start; a run of today stays open."""
    store = _stale(spark)
    audit.close_abandoned(spark, store, dry_run=False)
    shown = lambda r: r["ended_at"] and datetime.fromisoformat(r["ended_at"]).strftime("%Y-%m-%d %H:%M:%S")
    return frame(spark, [(r["run_id"], r["status"], shown(r)) for r in store.rows("SELECT * FROM pipeline_run WHERE run_id <> 'r'")], "run_id string, status string, ended_at string")


@query(values("run_id", ("stuck",), ("half done",), ("fresh",)))
def audit_running(spark: SparkSession, sf: str) -> DataFrame:
    return audit.Audit(audit.frames(spark, _stale(spark))).running().select("run_id")


@query(values("column_name, reaches_gold", ("document", "no"), ("email", "masked"), ("city", "in clear")))
def audit_posture(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, _ = one_object(spark, "customer", "full", "c_custkey")
    lake.store.update("source_object", {"id": obj.id}, gold_role="dimension")
    for column, sensitivity, masking in (("document", "sensitive_pii", "hash"), ("email", "pii", "hash"), ("city", "internal", "none"), ("free", "none", "none")):
        lake.store.insert("column_metadata", source_object_id=obj.id, column_name=column, sensitivity=sensitivity, masking_strategy=masking)
    return audit.Audit(audit.frames(spark, lake.store)).privacy_posture().select("column_name", "reaches_gold")


_VIEWS = ("recent_runs", "running", "object_health", "rule_performance", "freshness", "volume_trend", "quarantine", "unknown_members", "privacy")


@query(values("view_name, in_text, in_page", *((v, True, True) for v in _VIEWS)))
def audit_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    views = audit.Audit(audit.frames(spark, _stale(spark)))
    moment = at("2024-01-01")
    text, page = audit.report(views, moment), audit.html_report(views, moment)
    return frame(spark, [(v, f"== {v}\n" in text, f"<h2>{v.replace('_', ' ')}</h2>" in page) for v in views.snapshot(moment)], "view_name string, in_text boolean, in_page boolean")


# -- maintenance ------------------------------------------------------------------------------


def _parts(spark: SparkSession, sf: str, name: str = "parts") -> VersionedTable:
    out = VersionedTable(spark, f"{new_path(spark, 'tables')}/{name}")
    for i in range(4):
        out.append(table(spark, sf, "part").filter(F.col("p_partkey") % 4 == i).select("p_partkey", "p_size").coalesce(1))
    return out


@query(values("step, files, small", ("before", 4, 4), ("after", 1, 1)))
def table_stats(spark: SparkSession, sf: str) -> DataFrame:
    t = _parts(spark, sf)
    before = maintenance.file_stats(t)
    maintenance.compact(t)
    after = maintenance.file_stats(t)
    return frame(spark, [("before", before.files, before.small), ("after", after.files, after.small)], "step string, files bigint, small bigint")


@query("SELECT 'dead files' AS what, 4 AS n UNION ALL SELECT 'rows after', count(*) FROM part UNION ALL SELECT 'kept for a week', 0 UNION ALL SELECT 'quarantine refused', 1 UNION ALL SELECT 'short keeping refused', 1")
def table_vacuum(spark: SparkSession, sf: str) -> DataFrame:
    t = _parts(spark, sf)
    maintenance.compact(t)
    kept = len(maintenance.vacuum(t, dry_run=False))
    dead = len(maintenance.vacuum(t, hours=-1, enforce=False, dry_run=False))
    refused = []
    for bad, hours in ((VersionedTable(spark, f"{t.root}/quarantine/x"), 200), (t, 1)):
        try:
            maintenance.vacuum(bad, hours=hours)
            refused.append(0)
        except ValueError:
            refused.append(1)
    return frame(spark, [("dead files", dead), ("rows after", t.read().count()), ("kept for a week", kept), ("quarantine refused", refused[0]), ("short keeping refused", refused[1])], "what string, n bigint")


@query("SELECT version, operation, (SELECT count(*) FROM part WHERE p_partkey % 4 <= least(version, 3)) AS n, true AS found_by_time FROM (VALUES (0, 'append'), (1, 'append'), (2, 'append'), (3, 'append'), (4, 'compact')) t(version, operation)")
def table_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Every version with its rows, and whether the moment of its commit leads to it."""
    t = _parts(spark, sf)
    maintenance.compact(t)
    return frame(spark, [(m.version, m.operation, t.read(m.version).count(), t.version_at(m.ts) == m.version) for m in t.history()], "version bigint, operation string, n bigint, found_by_time boolean")


@query(values("name", ("a",), ("b",)))
def tables_found(spark: SparkSession, sf: str) -> DataFrame:
    root = new_path(spark, "tables")
    for name in ("a", "b"):
        VersionedTable(spark, f"{root}/{name}").overwrite(spark.range(1))
    return frame(spark, [(p.rsplit("/", 1)[-1],) for p in maintenance.tables_under(spark, root)], "name string")


@query("SELECT 'rows read again' AS what, count(*)::VARCHAR AS value FROM events WHERE ts > TIMESTAMP '2024-01-10' UNION ALL SELECT 'rewound to', '2024-01-10T00:00:00+00:00' UNION ALL SELECT 'later moment', 'refused' UNION ALL SELECT 'dry run', 'unchanged'")
def replay_rewind(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, run = one_object(spark, "events", "incremental", "event_id", "ts")
    source = FrameSource({"events": table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))})
    bronze.incremental_load(lake, source, obj, run)
    mark = lambda: lake.store.one("SELECT watermark_value FROM load_watermark")["watermark_value"]
    before = mark()
    replay.rewind(lake.store, obj, replay.parse_moment("2024-01-10"))
    dry = "unchanged" if mark() == before else "changed"
    replay.rewind(lake.store, obj, replay.parse_moment("2024-01-10"), dry_run=False)
    to = mark()
    again = bronze.incremental_load(lake, source, obj, run).rows_read
    try:
        replay.rewind(lake.store, obj, replay.parse_moment("2999-01-01T00:00:00Z"))
        later = "allowed"
    except ValueError:
        later = "refused"
    return frame(spark, [("rows read again", str(again)), ("rewound to", to), ("later moment", later), ("dry run", dry)], "what string, value string")


@query(values("given, moment", ("2024-01-02", "2024-01-02T00:00:00+00:00"), ("2024-01-02T03:04:05", "2024-01-02T03:04:05+00:00"), (" 2024-01-02T03:04:05+02:00 ", "2024-01-02T03:04:05+02:00")))
def parse_moments(spark: SparkSession, sf: str) -> DataFrame:
    given = ["2024-01-02", "2024-01-02T03:04:05", " 2024-01-02T03:04:05+02:00 "]
    return frame(spark, [(g, replay.parse_moment(g).isoformat()) for g in given], "given string, moment string")


# -- lineage, assets, control store -----------------------------------------------------------


@query(values("job, event, n_columns", ("bronze.region", "START", None), ("bronze.region", "COMPLETE", 2), ("silver.region", "START", None), ("silver.region", "COMPLETE", 5), ("bronze.region", "START", None), ("bronze.region", "FAIL", None)))
def lineage_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of two steps that went well and of one that failed after it had begun."""
    lake, obj, run = one_object(spark, "region", "full", "r_regionkey")
    with tempfile.TemporaryDirectory() as folder:
        lake.lineage = Lineage(f"{folder}/events.jsonl")
        bronze.full_load(lake, ParquetSource(spark, sf), obj, run)
        silver.build(lake, obj, run)
        try:
            bronze.full_load(lake, FrameSource({"region": table(spark, sf, "region").drop("r_name")}), obj, run)
        except drift.SchemaDriftError:
            pass
        events = lake.lineage.events()
    return frame(spark, [(e["job"], e["event"], len(e["output"]["columns"]) if "columns" in e.get("output", {}) else None) for e in events], "job string, event string, n_columns bigint")


@query(values("asset, waits_for", ("silver.orders", "bronze.orders"), ("gold.orders", "silver.orders"), ("gold.orders", "gold.customers"), ("silver.customers", "bronze.customers"), ("gold.customers", "silver.customers")))
def asset_edges(spark: SparkSession, sf: str) -> DataFrame:
    store = ControlStore()
    store.migrate()
    runner.register(store, "shop", [e for e in runner.SHOP if e.object_name in ("customers", "orders")])
    return frame(spark, [(a, w) for a, waits in runner.asset_graph(store).items() for w in waits], "asset string, waits_for string")


@query(values("step, version, missing", ("new", 0, 2), ("migrated", 2, 0), ("legacy", 1, 1)))
def store_migrations(spark: SparkSession, sf: str) -> DataFrame:
    new, legacy = ControlStore(), ControlStore()
    before = (new.version(), len(new.migrate(check=True)))
    new.migrate()
    legacy.db.executescript(ddl())
    return frame(spark, [("new", *before), ("migrated", new.version(), len(new.migrate(check=True))), ("legacy", legacy.version(), len(legacy.migrate(check=True)))], "step string, version bigint, missing bigint")


@query(values("dialect, tables, identity_keys", ("sqlite", 11, 0), ("postgres", 11, 9), ("mssql", 11, 9)))
def store_ddl(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, [(d, ddl(d).count("CREATE TABLE"), ddl(d).count("IDENTITY")) for d in DIALECTS], "dialect string, tables bigint, identity_keys bigint")


@query(values("setting, value", ("spark.driver.maxResultSize", "2g"), ("spark.driver.memory", "6g"), ("spark.sql.shuffle.partitions", None), ("spark.sql.session.timeZone", "UTC")))
def session_builder(spark: SparkSession, sf: str) -> DataFrame:
    found = session_settings({"TIDEMARK_MAX_RESULT": "2g", "TIDEMARK_DRIVER_MEMORY": "6g", "TIDEMARK_SHUFFLE_PARTITIONS": ""})
    names = ("spark.driver.maxResultSize", "spark.driver.memory", "spark.sql.shuffle.partitions", "spark.sql.session.timeZone")
    return frame(spark, [(n, found.get(n)) for n in names], "setting string, value string")


@query(values("command", *((c,) for c in ("pipeline", "seed", "privacy", "audit", "maintenance", "replay", "contracts", "migrate"))))
def cli_commands(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.__main__ import parser

    sub = next(a for a in parser()._actions if a.choices)
    return frame(spark, [(c,) for c in sub.choices], "command string")


@query(values("what, value", ("lake_root", "elsewhere"), ("log_level", "INFO"), ("logged", "hello")))
def settings_and_logs(spark: SparkSession, sf: str) -> DataFrame:
    os.environ["TIDEMARK_QUERY_LAKE_ROOT"] = "elsewhere"
    s = Settings.load("TIDEMARK_QUERY_")
    del os.environ["TIDEMARK_QUERY_LAKE_ROOT"]
    line = json.loads(JsonFormatter().format(logging.LogRecord("x", logging.INFO, "f", 1, "hello", (), None)))
    return frame(spark, [("lake_root", s.lake_root), ("log_level", s.log_level), ("logged", line["message"])], "what string, value string")
