"""Views over the control tables: each is one Spark SQL statement over DataFrames of any size (``views``)."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from html import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.control.store import TABLES, ControlStore, now

_KINDS = {"INTEGER": "bigint", "TEXT": "string", "REAL": "double"}
_TIMES = {"started_at", "ended_at", "evaluated_at", "captured_at", "created_at", "updated_at"}
ABANDONED_HOURS = 24


def frames(spark: SparkSession, store: ControlStore) -> dict[str, DataFrame]:
    """The control tables as DataFrames, times as timestamps."""
    out = {}
    for name, columns in TABLES.items():
        fields = [c.split()[:2] for c in columns if c.split()[0] not in ("UNIQUE", "CHECK")]
        schema = ", ".join(f"{c} {_KINDS[k]}" for c, k in fields)
        rows = [tuple(r[c] for c, _ in fields) for r in store.rows(f"SELECT * FROM {name}")]
        df = spark.createDataFrame(rows, schema)
        out[name] = df.withColumns({c: F.to_timestamp(c) for c, _ in fields if c in _TIMES})
    return out


class Audit:
    """The audit views over control tables given as DataFrames."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.t = tables
        self.spark = next(iter(tables.values())).sparkSession

    def _sql(self, text: str, **args) -> DataFrame:
        return self.spark.sql(text, **{k: v for k, v in self.t.items() if "{" + k + "}" in text}, args=args or None)

    def derived_status(self) -> DataFrame:
        """Each run's status from its tasks: failed before quarantined before succeeded; a run without tasks has succeeded."""
        return self._sql(
            """SELECT r.run_id, CASE WHEN bool_or(t.status = 'failed') THEN 'failed' WHEN bool_or(t.status = 'quarantined') THEN 'quarantined' ELSE 'succeeded' END AS status
            FROM {pipeline_run} r LEFT JOIN {task_run} t ON t.run_id = r.run_id GROUP BY r.run_id"""
        )

    def run_summary(self, run_id: str | None = None) -> DataFrame:
        rows = self._sql(
            """SELECT run_id, layer, count(*) AS tasks, sum(rows_read) AS rows_read, sum(rows_written) AS rows_written, sum(rows_rejected) AS rows_rejected, count_if(status = 'failed') AS failed
            FROM {task_run} GROUP BY run_id, layer ORDER BY run_id, layer"""
        )
        return rows if run_id is None else rows.filter(F.col("run_id") == run_id)

    def recent_runs(self, limit: int = 20) -> DataFrame:
        return self.t["pipeline_run"].orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit)

    def running(self) -> DataFrame:
        return self.t["pipeline_run"].filter("status = 'running'")

    def abandoned(self, at: datetime, hours: int = ABANDONED_HOURS) -> DataFrame:
        """Runs left running for too long with the status and end they should have: that of their last finished task, or their start if none has finished."""
        return self._sql(
            """SELECT r.run_id, CASE WHEN count(t.id) = 0 OR bool_or(t.status IN ('running', 'failed')) THEN 'failed' WHEN bool_or(t.status = 'quarantined') THEN 'quarantined' ELSE 'succeeded' END AS status,
              coalesce(max(t.ended_at), max(r.started_at)) AS ended_at
            FROM {pipeline_run} r LEFT JOIN {task_run} t ON t.run_id = r.run_id WHERE r.status = 'running' AND r.started_at < :edge GROUP BY r.run_id""",
            edge=at - timedelta(hours=hours),
        )

    def ranked_tasks(self) -> DataFrame:
        return self._sql("SELECT *, row_number() OVER (PARTITION BY source_object_id ORDER BY started_at DESC, id DESC) AS rank FROM {task_run}")

    def object_health(self, limit: int = 20) -> DataFrame:
        """Each object's last tasks: how many, how many failed, rows, and how the latest went."""
        return self._sql(
            """WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY source_object_id ORDER BY started_at DESC, id DESC) AS rank FROM {task_run}),
            recent AS (SELECT source_object_id, count(*) AS tasks, count_if(status = 'failed') AS failed, sum(rows_read) AS rows_read, sum(rows_written) AS rows_written, sum(rows_rejected) AS rows_rejected, max_by(status, -rank) AS last_status, max_by(started_at, -rank) AS last_started
              FROM ranked WHERE rank <= :n GROUP BY source_object_id)
            SELECT o.id AS source_object_id, o.object_name, o.owner, coalesce(tasks, 0) AS tasks, coalesce(failed, 0) AS failed, coalesce(rows_read, 0) AS rows_read, coalesce(rows_written, 0) AS rows_written, coalesce(rows_rejected, 0) AS rows_rejected, last_status, last_started
            FROM {source_object} o LEFT JOIN recent ON recent.source_object_id = o.id""",
            n=limit,
        )

    def rule_performance(self) -> DataFrame:
        return self._sql(
            """SELECT r.id AS rule_id, o.object_name, r.rule_type, r.column_name, r.severity, count(d.id) AS evaluations, count_if(d.passed = 0) AS failures, coalesce(sum(d.failed_row_count), 0) AS failed_rows,
              CASE WHEN count(d.id) = 0 THEN 1.0D ELSE 1.0D - count_if(d.passed = 0) / count(d.id) END AS pass_rate
            FROM {dq_rule} r JOIN {source_object} o ON o.id = r.source_object_id LEFT JOIN {dq_result} d ON d.dq_rule_id = r.id GROUP BY ALL"""
        )

    def freshness(self, at: datetime, layer: str = "silver") -> DataFrame:
        return self._sql(
            """WITH last AS (SELECT source_object_id, max(ended_at) AS loaded_at FROM {task_run} WHERE layer = :layer AND status IN ('succeeded', 'quarantined') GROUP BY source_object_id)
            SELECT o.id AS source_object_id, o.object_name, loaded_at, o.freshness_sla_minutes, floor((unix_micros(:at) - unix_micros(loaded_at)) / 60000000) AS age_minutes,
              o.freshness_sla_minutes IS NOT NULL AND (loaded_at IS NULL OR unix_micros(:at) - unix_micros(loaded_at) > o.freshness_sla_minutes * 60000000) AS breached
            FROM {source_object} o LEFT JOIN last ON last.source_object_id = o.id WHERE o.active = 1""",
            at=at, layer=layer,
        )

    def volume_trend(self, at: datetime, days: int = 30) -> DataFrame:
        return self._sql(
            """SELECT to_date(started_at) AS day, layer, count(*) AS tasks, sum(rows_read) AS rows_read, sum(rows_written) AS rows_written, sum(duration_seconds) AS seconds
            FROM {task_run} WHERE started_at >= :since GROUP BY 1, 2""",
            since=at - timedelta(days=days),
        )

    def quarantine_summary(self) -> DataFrame:
        """A row that breaks two rules counts in both."""
        return self._sql(
            """SELECT o.object_name, r.rule_type, r.column_name, sum(d.failed_row_count) AS failed_rows, count_if(d.passed = 0) AS breaches
            FROM {dq_result} d JOIN {dq_rule} r ON r.id = d.dq_rule_id JOIN {source_object} o ON o.id = r.source_object_id WHERE r.severity = 'quarantine' AND d.passed = 0 GROUP BY 1, 2, 3"""
        )

    def unknown_members(self) -> DataFrame:
        return self._sql(
            """WITH gold AS (SELECT *, row_number() OVER (PARTITION BY source_object_id ORDER BY started_at DESC, id DESC) AS rank FROM {task_run} WHERE layer = 'gold' AND status = 'succeeded')
            SELECT o.object_name, g.rows_rejected AS unresolved, g.rows_written FROM gold g JOIN {source_object} o ON o.id = g.source_object_id WHERE rank = 1 AND o.gold_role = 'fact'"""
        )

    def privacy_posture(self) -> DataFrame:
        return self._sql(
            """SELECT o.object_name, c.column_name, c.sensitivity, c.masking_strategy,
              CASE WHEN o.gold_role IS NULL THEN 'no' WHEN c.sensitivity = 'sensitive_pii' AND c.allow_in_gold = 0 THEN 'no' WHEN c.masking_strategy = 'none' THEN 'in clear' ELSE 'masked' END AS reaches_gold
            FROM {column_metadata} c JOIN {source_object} o ON o.id = c.source_object_id WHERE c.sensitivity <> 'none'"""
        )

    def snapshot(self, at: datetime | None = None) -> dict[str, DataFrame]:
        """All views against one clock."""
        at = at or datetime.now(UTC)
        return {
            "recent_runs": self.recent_runs(), "running": self.running(), "object_health": self.object_health(), "rule_performance": self.rule_performance(), "freshness": self.freshness(at),
            "volume_trend": self.volume_trend(at), "quarantine": self.quarantine_summary(), "unknown_members": self.unknown_members(), "privacy": self.privacy_posture(),
        }


def close_abandoned(spark: SparkSession, store: ControlStore, dry_run: bool = True, hours: int = ABANDONED_HOURS) -> list[dict]:
    found = [r.asDict() for r in Audit(frames(spark, store)).abandoned(datetime.now(UTC), hours).collect()]
    if not dry_run:
        for r in found:
            store.update("pipeline_run", {"run_id": r["run_id"]}, status=r["status"], ended_at=r["ended_at"].isoformat() if r["ended_at"] else now())
    return found


def html_report(audit: Audit, at: datetime | None = None, rows: int = 50) -> str:
    """The snapshot as one page without scripts; each view shows its first rows."""
    parts = []
    for name, df in audit.snapshot(at).items():
        head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{'' if v is None else escape(str(v))}</td>" for v in r) + "</tr>" for r in df.limit(rows).collect())
        parts.append(f"<section><h2>{escape(name.replace('_', ' '))}</h2><table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table></section>")
    style = "body{font:14px sans-serif}table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:2px 6px;text-align:left}"
    return f"<!doctype html><meta charset='utf-8'><title>audit</title><style>{style}</style><h1>Audit</h1>{''.join(parts)}"


def report(audit: Audit, at: datetime | None = None, rows: int = 20) -> str:
    """The snapshot as text."""
    out = []
    for name, df in audit.snapshot(at).items():
        out.append(f"== {name}\n{df._jdf.showString(rows, 40, False)}")
    return "\n".join(out)
