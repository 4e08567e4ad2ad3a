"""Queries of the engine's own operators over the driver's tables, each with the SQL it is checked against."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.control import drift
from tidemark.control.store import ControlStore, SourceObject
from tidemark.operators import cdc, conform, dedupe, privacy, quality, scd2, star, watermark
from tidemark.plans import audit as audit_plan
from tidemark.plans import bronze, kpi, runner, silver
from tidemark.plans.bronze import Lake
from tidemark.runtime import new_path
from tidemark.sources.seed import Seed
from tidemark.sources.source import FrameSource
from tidemark.sources.tables import table
from tidemark.storage import maintenance
from tidemark.storage.table import VersionedTable
from tidemark.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def us(c: str | Column) -> Column:
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


# -- dedupe -----------------------------------------------------------------------------------


@query("SELECT user_id, event_type, event_id, epoch_us(ts) AS ts_us, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.latest_per_key(table(spark, sf, "events"), ["user_id", "event_type"], "ts").select("user_id", "event_type", "event_id", us("ts").alias("ts_us"), "value")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_linenumber DESC,
    l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"""
)
def dedupe_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], "l_shipdate").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


# -- bronze -----------------------------------------------------------------------------------

MARK, GRACE = "2024-01-15 00:00:00", 86_400


@query(f"SELECT event_id, user_id, epoch_us(ts) AS ts_us, ts <= TIMESTAMP '{MARK}' AS reprocessed FROM events WHERE ts > TIMESTAMP '{MARK}' - INTERVAL {GRACE} SECOND")
def incremental_window(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    since = watermark.with_grace(at(MARK), GRACE, watermark.kind_of(events, "ts"))
    return watermark.newer_than(events, "ts", since).select("event_id", "user_id", us("ts").alias("ts_us"), (F.col("ts") <= F.lit(at(MARK))).alias("reprocessed"))


@query(f"SELECT max(epoch_us(ts)) AS watermark_us, count(*) AS rows_read, count(*) FILTER (ts <= TIMESTAMP '{MARK}') AS rows_reprocessed FROM events WHERE ts > TIMESTAMP '{MARK}' - INTERVAL {GRACE} SECOND")
def incremental_counters(spark: SparkSession, sf: str) -> DataFrame:
    window = incremental_window(spark, sf)
    return window.agg(F.max("ts_us").alias("watermark_us"), F.count("*").alias("rows_read"), F.count_if("reprocessed").alias("rows_reprocessed"))


_CHANGES = """changes AS (SELECT o_orderkey + CASE WHEN o_orderkey % 11 = 0 THEN 100000000 ELSE 0 END AS o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'D' WHEN o_orderkey % 35 = 3 THEN NULL ELSE 'U' END AS op, 'Z' AS o_orderstatus, round(o_totalprice + 1, 2) AS o_totalprice,
  o_orderkey % 3 AS seq FROM orders WHERE o_orderkey % 7 = 3 OR o_orderkey % 5 = 0)"""


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").filter((k % 7 == 3) | (k % 5 == 0)).select(
        (k + F.when(k % 11 == 0, 100_000_000).otherwise(0)).alias("o_orderkey"), F.when(k % 5 == 0, "D").when(k % 35 == 3, None).otherwise("U").alias("op"),
        F.lit("Z").alias("o_orderstatus"), F.round(F.col("o_totalprice") + 1, 2).alias("o_totalprice"), (k % 3).alias("seq"),
    )


@query(
    f"""WITH {_CHANGES} SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
    CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice, CASE WHEN s.o_orderkey IS NULL THEN 'keep' WHEN t.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS action
    FROM orders t FULL JOIN changes s ON s.o_orderkey = t.o_orderkey WHERE s.op IS DISTINCT FROM 'D'"""
)
def cdc_merge(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    batch = cdc.collapse(_changes(spark, sf), ["o_orderkey"], "seq").drop("seq")
    out = cdc.merged(target, batch, ["o_orderkey"], "op", "D").filter(~F.col("__action").isin("delete", "ignore"))
    return out.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("__action").alias("action"))


@query(f"WITH {_CHANGES} SELECT count(*) FILTER (op IS DISTINCT FROM 'D') AS upserts, count(*) FILTER (op = 'D') AS deletes FROM changes")
def cdc_split(spark: SparkSession, sf: str) -> DataFrame:
    gone = cdc.is_delete(_changes(spark, sf), "op", "D")
    return _changes(spark, sf).agg(F.count_if(~gone).alias("upserts"), F.count_if(gone).alias("deletes"))


# -- conformance ------------------------------------------------------------------------------


@query(r"SELECT c_custkey AS customer_id, regexp_replace(c_name, '^\s+|\s+$', '', 'g') AS full_name, CAST(c_custkey * 86400000000 AS BIGINT) AS updated_us FROM customer")
def conform_customer(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "customer").select(F.col("c_custkey").alias("CustomerID"), F.concat(F.lit("\t "), F.col("c_name"), F.lit(" \n")).alias(" Full--Name "), (F.col("c_custkey") * 86400).alias("updatedAt"))
    return conform.conform(raw).select("customer_id", "full_name", us("updated_at").alias("updated_us"))


# -- quality ----------------------------------------------------------------------------------

RULES = [
    quality.Rule(1, "not_null", "fail", "l_orderkey"),
    quality.Rule(2, "range", "quarantine", "l_quantity", json.dumps({"minimum": 2, "maximum": 48})),
    quality.Rule(3, "allowed_values", "quarantine", "l_returnflag", json.dumps({"values": ["A", "N"]})),
    quality.Rule(4, "regex", "warn", "l_linestatus", json.dumps({"pattern": "^[F]$"})),
    quality.Rule(5, "unique", "warn", "l_orderkey"),
    quality.Rule(6, "row_count", "warn", None, json.dumps({"minimum": 1})),
]
_BROKEN = """m AS (SELECT *, l_orderkey IS NULL AS r1, coalesce(l_quantity < 2 OR l_quantity > 48, false) AS r2, coalesce(l_returnflag NOT IN ('A', 'N'), false) AS r3,
  coalesce(NOT regexp_matches(l_linestatus, '^[F]$'), false) AS r4, l_orderkey IS NOT NULL AND count(*) OVER (PARTITION BY l_orderkey) > 1 AS r5 FROM lineitem)"""


@query(
    f"""WITH {_BROKEN} SELECT unnest([1, 2, 3, 4, 5, 6])::BIGINT AS rule_id, unnest([count(*) FILTER (r1), count(*) FILTER (r2), count(*) FILTER (r3), count(*) FILTER (r4), count(*) FILTER (r5), 0])::BIGINT AS failed_rows FROM m"""
)
def quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    report = quality.evaluate(table(spark, sf, "lineitem"), RULES)
    return spark.createDataFrame([(r.rule.id, r.failed_rows) for r in report.results], "rule_id bigint, failed_rows bigint")


@query(f"WITH {_BROKEN} SELECT l_orderkey, l_linenumber, concat_ws(', ', CASE WHEN r2 THEN 'range:l_quantity' END, CASE WHEN r3 THEN 'allowed_values:l_returnflag' END) AS reason FROM m WHERE r2 OR r3")
def quality_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quality.evaluate(table(spark, sf, "lineitem"), RULES).rejected.select("l_orderkey", "l_linenumber", F.col("_rejection_reason").alias("reason"))


@query(f"WITH {_BROKEN} SELECT l_orderkey, l_linenumber, l_quantity FROM m WHERE NOT (r2 OR r3)")
def quality_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return quality.evaluate(table(spark, sf, "lineitem"), RULES).accepted.select("l_orderkey", "l_linenumber", "l_quantity")


# -- history ----------------------------------------------------------------------------------

_T1, _T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _history(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    first = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    second = first.filter("c_custkey % 11 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, "CHANGED").otherwise(F.col("c_mktsegment")))
    fresh = first.filter("c_custkey % 100 = 1").withColumn("c_custkey", F.col("c_custkey") + 1_000_000)
    return first, second.unionByName(fresh)


_SCD2_BATCH = """b AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey + 1000000, c_name, c_mktsegment FROM customer WHERE c_custkey % 100 = 1)"""


def _marked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    first, second = _history(spark, sf)
    history = scd2.with_history(first, ["c_custkey"], F.lit(at(_T1)))
    return history, scd2.classified(history, second, ["c_custkey"], F.lit(at(_T2)), F.lit(at(_T2)), tombstones=True)


@query(
    f"""WITH {_SCD2_BATCH}, t AS (SELECT epoch_us(TIMESTAMP '{_T1}') AS t1, epoch_us(TIMESTAMP '{_T2}') AS t2)
    SELECT c.c_custkey, c.c_mktsegment, t1 AS from_us, CASE WHEN b.c_custkey IS NULL OR b.c_mktsegment <> c.c_mktsegment THEN t2 END AS to_us, b.c_custkey IS NOT NULL AND b.c_mktsegment = c.c_mktsegment AS is_current, false AS is_deleted FROM customer c LEFT JOIN b USING (c_custkey), t
    UNION ALL SELECT b.c_custkey, b.c_mktsegment, t2, NULL, true, false FROM b LEFT JOIN customer c USING (c_custkey), t WHERE c.c_custkey IS NULL OR b.c_mktsegment <> c.c_mktsegment
    UNION ALL SELECT c.c_custkey, c.c_mktsegment, t2, NULL, true, true FROM customer c LEFT JOIN b USING (c_custkey), t WHERE b.c_custkey IS NULL"""
)
def scd2_second_batch(spark: SparkSession, sf: str) -> DataFrame:
    out = scd2.rewritten(*_marked(spark, sf))
    return out.select("c_custkey", "c_mktsegment", us("valid_from").alias("from_us"), us("valid_to").alias("to_us"), "is_current", "is_deleted")


@query(
    f"""WITH {_SCD2_BATCH} SELECT CASE WHEN b.c_custkey IS NULL THEN 'tombstone' WHEN c.c_custkey IS NULL THEN 'open' WHEN b.c_mktsegment = c.c_mktsegment THEN 'unchanged' ELSE 'change' END AS action, count(*) AS n
    FROM customer c FULL JOIN b USING (c_custkey) GROUP BY 1"""
)
def scd2_actions(spark: SparkSession, sf: str) -> DataFrame:
    return _marked(spark, sf)[1].groupBy("action").agg(F.count("*").alias("n"))


# -- star schema ------------------------------------------------------------------------------


def _key_sql(*columns: str) -> str:
    joined = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"CAST(greatest(CAST('0x' || substr(sha256(concat_ws(chr(31), {joined})), 1, 16) AS UBIGINT) >> 1, 1) AS BIGINT)"


@query(f"SELECT {_key_sql('c_custkey')} AS customer_key, c_custkey, c_name, c_mktsegment FROM customer UNION ALL SELECT 0, NULL, NULL, NULL")
def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return star.dimension(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "customer", ["c_custkey"])


_FACT = f"""fact AS (SELECT l_orderkey, l_linenumber, l_quantity, coalesce(CASE WHEN l_partkey % 50 <> 0 THEN {_key_sql('p_partkey')} END, 0) AS part_key, coalesce(CASE WHEN s_suppkey IS NOT NULL THEN {_key_sql('s_suppkey')} END, 0) AS supplier_key
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 10 <> 0)"""


def _fact(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    parts = table(spark, sf, "part").filter("p_partkey % 50 <> 0").select("p_partkey", "p_name")
    suppliers = table(spark, sf, "supplier").filter("s_suppkey % 10 <> 0").select("s_suppkey", "s_name")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    return star.fact(rows, [star.Reference("l_partkey", "part", parts, ["p_partkey"]), star.Reference("l_suppkey", "supplier", suppliers, ["s_suppkey"])])


@query(f"WITH {_FACT} SELECT * FROM fact")
def fact_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)[0]


@query(f"WITH {_FACT} SELECT count(*) FILTER (part_key = 0) AS part_key, count(*) FILTER (supplier_key = 0) AS supplier_key FROM fact")
def fact_unresolved(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = _fact(spark, sf)
    return spark.createDataFrame([star.unresolved(rows, names)], ", ".join(f"{n} bigint" for n in names))


_AS_OF = """h AS (SELECT c_custkey, TIMESTAMP '1995-01-01' + (c_custkey % 365) * INTERVAL 1 DAY AS valid_from, 'first' AS state, false AS is_deleted FROM customer
  UNION ALL SELECT c_custkey, TIMESTAMP '1996-07-01' + (c_custkey % 90) * INTERVAL 1 DAY, 'second', c_custkey % 9 = 0 FROM customer)"""


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    day = lambda start, n: (F.lit(at(start)) + F.make_dt_interval(F.col("c_custkey") % n)).alias("valid_from")
    first = c.select("c_custkey", day("1995-01-01", 365), F.lit("first").alias("state"), F.lit(False).alias("is_current"), F.lit(False).alias("is_deleted"))
    second = c.select("c_custkey", day("1996-07-01", 90), F.lit("second").alias("state"), F.lit(True).alias("is_current"), (F.col("c_custkey") % 9 == 0).alias("is_deleted"))
    return first.unionByName(second)


@query(
    f"""WITH {_AS_OF}, live AS (SELECT * FROM h WHERE NOT is_deleted) SELECT o_orderkey, coalesce(CASE WHEN c_custkey IS NOT NULL THEN CAST(greatest(CAST('0x' || substr(sha256(concat_ws(chr(31), CAST(c_custkey AS VARCHAR), CAST(epoch_us(valid_from) AS VARCHAR))), 1, 16) AS UBIGINT) >> 1, 1) AS BIGINT) END, 0) AS customer_key
    FROM orders o ASOF LEFT JOIN live ON o.o_custkey = live.c_custkey AND o.o_orderdate >= live.valid_from"""
)
def asof_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ref = star.Reference("o_custkey", "customer", _versions(spark, sf), ["c_custkey"], history=True)
    return star.fact(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), [ref], "o_orderdate")[0].select("o_orderkey", "customer_key")


# -- privacy ----------------------------------------------------------------------------------

KEY = b"a-key"


def _pad_sql(x: int, key: bytes = KEY) -> str:
    return f"unhex('{bytes(b ^ x for b in key.ljust(64, bytes(1))).hex()}')"


@query(
    f"""SELECT c_custkey, substr(sha256({_pad_sql(0x5C)} || unhex(sha256({_pad_sql(0x36)} || encode(c_name)))), 1, 32) AS hashed,
    CASE WHEN length(c_mktsegment) <= 4 THEN repeat('*', length(c_mktsegment)) ELSE repeat('*', length(c_mktsegment) - 4) || right(c_mktsegment, 4) END AS cut, CAST(NULL AS DOUBLE) AS hidden FROM customer"""
)
def mask_customer(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("hashed"), F.col("c_mktsegment").alias("cut"), F.col("c_acctbal").alias("hidden"))
    return privacy.apply_masks(rows, {"hashed": "hash", "cut": "partial", "hidden": "redact"}, KEY)[0]


@query("SELECT * FROM (VALUES ('customer_email', 'pii', 'hash'), ('customer_phone', 'pii', 'partial'), ('customer_city', 'internal', 'none'), ('customer_zip_prefix', 'internal', 'none')) t(column_name, sensitivity, masking)")
def privacy_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer_snapshots").select("customer_id", "customer_email", "customer_phone", "customer_city", "customer_zip_prefix")
    return spark.createDataFrame([(p.column, p.sensitivity, p.masking) for p in privacy.scan(rows)], "column_name string, sensitivity string, masking string")


# -- audit ------------------------------------------------------------------------------------

_NOW = "2024-06-30 00:00:00"


def _control(spark: SparkSession, sf: str) -> audit_plan.Audit:
    """Control tables from the logs: each logged run is a task, its layer by its number; rule results by the rules' logs."""
    runs = table(spark, sf, "incremental_runs").dropDuplicates(["run_no"])
    layer = F.element_at(F.array(F.lit("bronze"), F.lit("silver"), F.lit("gold")), (F.col("run_no") % 3 + 1).cast("int"))
    task = runs.select(
        F.col("run_no").alias("id"), "run_id", "source_object_id", layer.alias("layer"), "status", "rows_read", "rows_written", F.col("rows_reprocessed").alias("rows_rejected"), "started_at", "ended_at",
        (F.unix_micros("ended_at") - F.unix_micros("started_at")).cast("double").alias("duration_seconds"),
    )
    pipeline = runs.groupBy("run_id").agg(F.max_by("status", F.struct("started_at", "run_no")).alias("status"), F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"))
    logs = table(spark, sf, "rule_performance").filter("rule_id is not null")
    rules = logs.groupBy(F.col("rule_id").alias("id")).agg(F.min("rule_type").alias("rule_type"), F.min("column_name").alias("column_name"), F.min("severity").alias("severity"))
    rules = rules.withColumn("source_object_id", F.col("id") % 4 + 1)
    results = logs.select(F.col("rule_id").alias("dq_rule_id"), (F.col("failures") == 0).cast("bigint").alias("passed"), F.greatest("failures", F.lit(0)).alias("failed_row_count"), F.lit(1).cast("bigint").alias("id"))
    objects = table(spark, sf, "source_object").withColumns({"active": F.col("active").cast("bigint")})
    return audit_plan.Audit({"task_run": task, "pipeline_run": pipeline, "dq_rule": rules, "dq_result": results, "source_object": objects})


_TASKS = """once AS (SELECT run_no, any_value(run_id) AS run_id, any_value(source_object_id) AS source_object_id, any_value(status) AS status, any_value(started_at) AS started_at, any_value(ended_at) AS ended_at, any_value(rows_read) AS rows_read,
  any_value(rows_written) AS rows_written, any_value(rows_reprocessed) AS rows_reprocessed FROM incremental_runs GROUP BY run_no),
task AS (SELECT run_no AS id, run_id, source_object_id, ['bronze', 'silver', 'gold'][run_no % 3 + 1] AS layer, status, rows_read, rows_written, rows_reprocessed AS rows_rejected, started_at, ended_at FROM once)"""
_RESULTS = """logs AS (SELECT * FROM rule_performance WHERE rule_id IS NOT NULL), rules AS (SELECT rule_id AS id, min(rule_type) AS rule_type, min(column_name) AS column_name, min(severity) AS severity FROM logs GROUP BY 1)"""


@query(f"WITH {_TASKS} SELECT run_id, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'quarantined') THEN 'quarantined' ELSE 'succeeded' END AS status FROM task GROUP BY 1")
def audit_status(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).derived_status()


@query(f"WITH {_TASKS} SELECT run_id, layer, count(*) AS tasks, sum(rows_read)::BIGINT AS rows_read, sum(rows_written)::BIGINT AS rows_written, sum(rows_rejected)::BIGINT AS rows_rejected, count(*) FILTER (status = 'failed') AS failed FROM task GROUP BY 1, 2")
def audit_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).run_summary()


@query(
    """WITH once AS (SELECT DISTINCT run_no, run_id, status, started_at FROM incremental_runs) SELECT run_id, arg_max(status, {'s': started_at, 'n': run_no}) AS status, epoch_us(min(started_at)) AS started_us FROM once GROUP BY run_id
    ORDER BY started_us DESC, run_id DESC LIMIT 20"""
)
def audit_recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).recent_runs().select("run_id", "status", us("started_at").alias("started_us"))


@query(
    f"""WITH {_TASKS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY source_object_id ORDER BY started_at DESC, id DESC) AS r FROM task),
    recent AS (SELECT source_object_id, count(*) AS tasks, count(*) FILTER (status = 'failed') AS failed, sum(rows_read)::BIGINT AS rows_read, sum(rows_written)::BIGINT AS rows_written, sum(rows_rejected)::BIGINT AS rows_rejected, max(status) FILTER (r = 1) AS last_status FROM ranked WHERE r <= 20 GROUP BY 1)
    SELECT o.id AS source_object_id, object_name, owner, coalesce(tasks, 0) AS tasks, coalesce(failed, 0) AS failed, coalesce(rows_read, 0) AS rows_read, coalesce(rows_written, 0) AS rows_written, coalesce(rows_rejected, 0) AS rows_rejected, last_status FROM source_object o LEFT JOIN recent ON recent.source_object_id = o.id"""
)
def audit_object_health(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).object_health().drop("last_started")


@query(
    f"""WITH {_RESULTS} SELECT r.id AS rule_id, object_name, r.rule_type, r.column_name, r.severity, count(l.rule_id) AS evaluations, count(*) FILTER (l.failures <> 0) AS failures, coalesce(sum(greatest(l.failures, 0)), 0)::BIGINT AS failed_rows,
    round(1 - count(*) FILTER (l.failures <> 0) / count(l.rule_id), 6) AS pass_rate FROM rules r JOIN source_object o ON o.id = r.id % 4 + 1 LEFT JOIN logs l ON l.rule_id = r.id GROUP BY ALL"""
)
def audit_rule_performance(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).rule_performance().withColumn("pass_rate", F.round("pass_rate", 6))


@query(
    f"""WITH {_TASKS}, last AS (SELECT source_object_id, max(ended_at) AS t FROM task WHERE layer = 'silver' AND status IN ('succeeded', 'quarantined') GROUP BY 1)
    SELECT o.id AS source_object_id, object_name, epoch_us(t) AS loaded_us, freshness_sla_minutes, freshness_sla_minutes IS NOT NULL AND (t IS NULL OR epoch_us(TIMESTAMPTZ '{_NOW}+00') - epoch_us(t) > freshness_sla_minutes * 60000000) AS breached
    FROM source_object o LEFT JOIN last ON last.source_object_id = o.id WHERE active"""
)
def audit_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).freshness(at(_NOW)).select("source_object_id", "object_name", us("loaded_at").alias("loaded_us"), "freshness_sla_minutes", "breached")


@query(
    f"""WITH {_TASKS} SELECT CAST(date_trunc('day', started_at AT TIME ZONE 'UTC') AS DATE) AS day, layer, count(*) AS tasks, sum(rows_read)::BIGINT AS rows_read, sum(rows_written)::BIGINT AS rows_written FROM task
    WHERE started_at >= TIMESTAMPTZ '{_NOW}+00' - INTERVAL 90 DAY GROUP BY 1, 2"""
)
def audit_volume_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).volume_trend(at(_NOW), 90).drop("seconds")


@query(
    f"""WITH {_RESULTS} SELECT object_name, r.rule_type, r.column_name, sum(greatest(failures, 0))::BIGINT AS failed_rows, count(*) AS breaches FROM logs l JOIN rules r ON r.id = l.rule_id JOIN source_object o ON o.id = r.id % 4 + 1
    WHERE r.severity = 'quarantine' AND failures <> 0 GROUP BY ALL"""
)
def audit_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).quarantine_summary()


@query(
    f"""WITH {_TASKS} SELECT object_name, rows_rejected AS unresolved, rows_written FROM (SELECT *, row_number() OVER (PARTITION BY source_object_id ORDER BY started_at DESC, id DESC) AS r FROM task WHERE layer = 'gold' AND status = 'succeeded') g
    JOIN source_object o ON o.id = g.source_object_id WHERE r = 1 AND gold_role = 'fact'"""
)
def audit_unknown_members(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).unknown_members()


# -- storage ----------------------------------------------------------------------------------


def _fragmented(spark: SparkSession, sf: str) -> VersionedTable:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = VersionedTable(spark, new_path(spark, "orders"))
    for i in range(3):
        out.append(orders.filter(F.col("o_orderkey") % 3 == i))
    return out


_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"


@query(_ORDERS)
def table_compacted(spark: SparkSession, sf: str) -> DataFrame:
    out = _fragmented(spark, sf)
    maintenance.compact(out)
    return out.read()


@query(_ORDERS + " WHERE o_custkey BETWEEN 10 AND 40")
def table_zordered_range(spark: SparkSession, sf: str) -> DataFrame:
    out = _fragmented(spark, sf)
    maintenance.zorder(out, ["o_custkey", "o_orderkey"], files=8)
    return out.read_range("o_custkey", 10, 40)


@query(_ORDERS + " WHERE o_orderkey % 3 = 0")
def table_time_travel(spark: SparkSession, sf: str) -> DataFrame:
    out = _fragmented(spark, sf)
    out.restore(0, dry_run=False)
    return out.read()


# -- whole pipeline ---------------------------------------------------------------------------


def shop_lake(spark: SparkSession, sf: str) -> Lake:
    """Customers with history and orders with a reference, through bronze, silver and gold."""
    store = ControlStore()
    store.migrate()
    lake = Lake(spark, new_path(spark, "lake"), store)
    runner.register(store, "driver", [
        runner.CatalogEntry("customer", "full", "c_custkey", "dimension", scd2_enabled=False, load_order=10),
        runner.CatalogEntry("orders", "incremental", "o_orderkey", "fact", "o_orderdate", references=(("o_custkey", "customer"),)),
    ])
    frames = {"customer": table(spark, sf, "customer"), "orders": table(spark, sf, "orders")}
    report = runner.run_pipeline(lake, FrameSource(frames))
    if report.failures:
        raise RuntimeError(str(report))
    return lake


@query(f"SELECT o_orderkey, {_key_sql('o_custkey')} AS customer_key, o_orderstatus, o_totalprice FROM orders")
def pipeline_fact_orders(spark: SparkSession, sf: str) -> DataFrame:
    return shop_lake(spark, sf).table("gold/fact_orders").read().select("o_orderkey", "customer_key", "o_orderstatus", "o_totalprice")


@query()
def seed_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return Seed(spark, 5000).table("order_items")


# -- loads, one by one ------------------------------------------------------------------------


def one_object(spark: SparkSession, name: str, strategy: str, keys: str, incremental: str | None = None, **settings) -> tuple[Lake, SourceObject, str]:
    """A fresh lake with one object and a run."""
    store = ControlStore()
    store.migrate()
    lake = Lake(spark, new_path(spark, "lake"), store)
    ids = runner.register(store, "driver", [runner.CatalogEntry(name, strategy, keys, None, incremental)])
    if settings:
        store.update("source_object", {"id": ids[name]}, **settings)
    store.insert("pipeline_run", run_id="r", pipeline_name="query", status="running", started_at="2024-01-01T00:00:00+00:00")
    return lake, store.object(ids[name]), "r"


@query("SELECT o_orderkey, o_custkey, o_orderstatus, 'orders' AS _source FROM orders")
def bronze_full_load(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, run = one_object(spark, "orders", "full", "o_orderkey")
    bronze.full_load(lake, FrameSource({"orders": table(spark, sf, "orders")}), obj, run)
    return lake.table(obj.target_path).read().select("o_orderkey", "o_custkey", "o_orderstatus", "_source")


@query(f"SELECT event_id FROM events WHERE ts <= TIMESTAMP '{MARK}' UNION ALL SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{MARK}') - INTERVAL {GRACE} SECOND")
def bronze_incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: what the second reads again inside the grace window is appended again, and silver deduplicates it."""
    lake, obj, run = one_object(spark, "events", "incremental", "event_id", "ts", watermark_grace=GRACE)
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for batch in (events.filter(F.col("ts") <= F.lit(at(MARK))), events):
        bronze.incremental_load(lake, FrameSource({"events": batch}), obj, run)
    return lake.table(obj.target_path).read().select("event_id")


@query(
    f"""WITH {_CHANGES} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN 'F' ELSE s.o_orderstatus END AS o_orderstatus
    FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0) t FULL JOIN changes s ON s.o_orderkey = t.o_orderkey WHERE s.op IS DISTINCT FROM 'D'"""
)
def bronze_cdc_load(spark: SparkSession, sf: str) -> DataFrame:
    lake, obj, run = one_object(spark, "orders", "cdc", "o_orderkey", "seq", cdc_operation_column="op")
    changes = _changes(spark, sf)
    first = table(spark, sf, "orders").filter("o_orderkey % 2 = 0").select("o_orderkey", F.lit("I").alias("op"), F.lit("F").alias("o_orderstatus"), "o_totalprice", (F.col("o_orderkey") * 0).alias("seq"))
    for batch in (first, changes):
        bronze.cdc_load(lake, FrameSource({"orders": batch}), obj, run)
    return lake.table(obj.target_path).read().select("o_orderkey", "o_orderstatus")


def _silver_lineitem(spark: SparkSession, sf: str) -> Lake:
    lake, obj, run = one_object(spark, "lineitem", "full", "l_orderkey, l_linenumber")
    for r in RULES[1:4]:
        lake.store.insert("dq_rule", id=r.id, source_object_id=obj.id, rule_type=r.rule_type, column_name=r.column, severity=r.severity, expression=r.expression)
    unique = dedupe.latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")
    bronze.full_load(lake, FrameSource({"lineitem": unique}), obj, run)
    silver.build(lake, obj, run, at(_NOW))
    return lake


_KEPT = """kept AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1)"""
_OUT = "(coalesce(l_quantity < 2 OR l_quantity > 48, false) OR coalesce(l_returnflag NOT IN ('A', 'N'), false))"


@query(f"WITH {_KEPT} SELECT l_orderkey, l_linenumber, l_quantity FROM kept WHERE NOT {_OUT}")
def silver_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_lineitem(spark, sf).table("silver/lineitem").read().select("l_orderkey", "l_linenumber", "l_quantity")


@query(f"WITH {_KEPT} SELECT l_orderkey, l_linenumber, 'bronze/lineitem' AS _rejected_from FROM kept WHERE {_OUT}")
def quarantine_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_lineitem(spark, sf).table("quarantine/lineitem").read().select("l_orderkey", "l_linenumber", "_rejected_from")


@query("SELECT * FROM (VALUES ('added', 'extra'), ('removed', 'o_orderdate'), ('retyped', 'o_custkey')) t(change_type, column_name)")
def schema_compare(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "orders")
    new = old.drop("o_orderdate").withColumns({"o_custkey": F.col("o_custkey").cast("string"), "extra": F.lit(1)})
    found = drift.compare(drift.describe(old), drift.describe(new))
    return spark.createDataFrame([(k, c) for k in ("added", "removed", "retyped") for c in getattr(found, k)], "change_type string, column_name string")


@query(
    f"""WITH {_TASKS}, p AS (SELECT run_id, arg_max(status, {{'s': started_at, 'n': run_no}}) AS status, min(started_at) AS started_at FROM once GROUP BY run_id)
    SELECT p.run_id, CASE WHEN bool_or(t.status IN ('running', 'failed')) THEN 'failed' WHEN bool_or(t.status = 'quarantined') THEN 'quarantined' ELSE 'succeeded' END AS status, epoch_us(coalesce(max(t.ended_at), min(p.started_at))) AS ended_us FROM p JOIN task t USING (run_id)
    WHERE p.status = 'running' AND p.started_at < TIMESTAMPTZ '{_NOW}+00' - INTERVAL 24 HOUR GROUP BY 1"""
)
def audit_abandoned(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).abandoned(at(_NOW)).select("run_id", "status", us("ended_at").alias("ended_us"))


@query("SELECT event_id, user_id FROM events")
def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    """The files of a table as a stream of micro-batches into a versioned table."""
    events = table(spark, sf, "events")
    out = VersionedTable(spark, new_path(spark, "streamed"))
    # a pattern, since a stream refuses the plain path of one file
    stream = ingest.parquet_stream(spark, f"{sf}/event[s].parquet", events.schema)
    ingest.append_stream(stream, out, new_path(spark, "stream-state")).awaitTermination()
    return out.read().select("event_id", "user_id")


# -- figures ----------------------------------------------------------------------------------


@query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(sum(CAST(o_totalprice AS DECIMAL(18, 4))), 2)::DOUBLE AS revenue, count(*) AS orders FROM orders GROUP BY 1")
def kpi_revenue_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.revenue_by_month(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")


@query("SELECT l_partkey, round(sum(CAST(l_extendedprice AS DECIMAL(18, 4))), 2)::DOUBLE AS revenue FROM lineitem GROUP BY 1 ORDER BY revenue DESC, l_partkey LIMIT 10")
def kpi_top_parts(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.top(table(spark, sf, "lineitem"), "l_partkey", "l_extendedprice", 10)


@query("SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def kpi_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.distribution(table(spark, sf, "orders"), "o_orderpriority")


@query("SELECT round(avg(CAST(o_totalprice AS DECIMAL(18, 4))), 2)::DOUBLE AS average_order_value FROM orders")
def kpi_average_order_value(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.average(table(spark, sf, "orders"), "o_totalprice")
