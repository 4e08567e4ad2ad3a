"""Row and table rules in three severities.

All row rules become flag columns of one projection; their counts, the row count and the newest times come from one aggregate; accepted and rejected rows are
two filters. No rule has a job of its own. A null passes every rule but not_null.
"""

from __future__ import annotations

import json
import math
import re
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import snake_case

ROW_RULES = ("not_null", "unique", "range", "allowed_values", "regex")
TABLE_RULES = ("row_count", "freshness")


class RuleError(ValueError):
    """A rule that can't be evaluated as it is configured."""


class QualityFailure(RuntimeError):
    """A rule of severity fail is broken. ``report`` has all results."""

    def __init__(self, message: str, report: QualityReport):
        super().__init__(message)
        self.report = report


@dataclass(frozen=True)
class Rule:
    id: int
    rule_type: str
    severity: str = "warn"
    column: str | None = None
    expression: str | None = None

    @property
    def flag(self) -> str:
        return f"__rule_{self.id}"

    @property
    def label(self) -> str:
        return f"{self.rule_type}:{self.column}"

    @property
    def by_row(self) -> bool:
        return self.rule_type in ROW_RULES

    def params(self) -> dict:
        try:
            raw = json.loads(self.expression) if self.expression else {}
        except ValueError as e:
            raise RuleError(f"rule {self.id}: expression isn't JSON: {e}") from e
        if not isinstance(raw, dict):
            raise RuleError(f"rule {self.id}: expression must be a JSON object")
        return {k: v for k, v in raw.items() if v is not None}  # a bound given as null is none


@dataclass(frozen=True)
class RuleResult:
    rule: Rule
    passed: bool
    failed_rows: int
    detail: str | None = None


@dataclass
class QualityReport:
    rows: int
    results: list[RuleResult]
    accepted: DataFrame
    rejected: DataFrame
    rejected_rows: int = 0
    flags: list[str] = field(default_factory=list)


def search_pattern(pattern: str) -> str:
    """A pattern whose last ``$`` means the end of the text only; Java's also matches before a final line break."""
    return re.sub(r"(?<!\\)((?:\\\\)*)\$$", r"\1\\z", pattern)


def checked(df: DataFrame, rule: Rule) -> Rule:
    """The rule with its column as the conformed table names it, or RuleError."""
    if rule.rule_type == "custom_sql":
        raise RuleError(f"rule {rule.id}: custom_sql isn't implemented")
    if rule.rule_type not in (*ROW_RULES, *TABLE_RULES):
        raise RuleError(f"rule {rule.id}: unknown type {rule.rule_type}")
    p = rule.params()
    if rule.rule_type == "row_count":
        if not {"minimum", "maximum"} & p.keys():
            raise RuleError(f"rule {rule.id}: row_count needs minimum or maximum")
        return rule
    name = rule.column if rule.column in df.columns else snake_case(rule.column or "")
    if name not in df.columns:
        raise RuleError(f"rule {rule.id}: no column {rule.column}")
    needed = {"range": ({"minimum", "maximum"}, any), "allowed_values": ({"values"}, all), "regex": ({"pattern"}, all), "freshness": ({"max_age_minutes"}, all)}
    if rule.rule_type in needed:
        keys, how = needed[rule.rule_type]
        if not how(k in p for k in keys):
            raise RuleError(f"rule {rule.id}: {rule.rule_type} needs {', '.join(sorted(keys))}")
    if rule.rule_type == "allowed_values" and not isinstance(p["values"], list):
        raise RuleError(f"rule {rule.id}: values must be a list")
    if rule.rule_type == "regex":
        try:  # by the engine that will run it
            df.sparkSession.sparkContext._jvm.java.util.regex.Pattern.compile(search_pattern(p["pattern"]))
        except Exception as e:  # noqa: BLE001 - py4j wraps the Java exception
            raise RuleError(f"rule {rule.id}: bad pattern {p['pattern']!r}") from e
    return Rule(rule.id, rule.rule_type, rule.severity, name, rule.expression)


def broken(df: DataFrame, rule: Rule) -> Column:
    """True where a row breaks a checked row rule that looks at the row alone."""
    c, p = F.col(f"`{rule.column}`"), rule.params()
    if rule.rule_type == "not_null":
        return c.isNull()
    if rule.rule_type == "range":
        tests = [c < F.lit(p["minimum"])] if "minimum" in p else []
        if "maximum" in p:
            tests.append(c > F.lit(p["maximum"]))
        outside = tests[0] if len(tests) == 1 else tests[0] | tests[1]
        if isinstance(df.schema[rule.column].dataType, (T.DoubleType, T.FloatType)):
            outside = ~F.isnan(c) & outside  # NaN is above everything in Spark, but outside of no range
        return F.coalesce(outside, F.lit(False))
    if rule.rule_type == "allowed_values":
        return F.coalesce(~c.isin([v for v in p["values"] if v is not None]), F.lit(False))
    return F.coalesce(~c.cast("string").rlike(search_pattern(p["pattern"])), F.lit(False))


def with_repeats(df: DataFrame, rule: Rule) -> DataFrame:
    """``df`` with the flag of a unique rule. Values are counted map-side and joined back where they repeat: nulls, however many, aren't counted, and a value that fills the table is one row there and a skewed key
    of a join here, which AQE splits."""
    c, value = F.col(f"`{rule.column}`"), f"{rule.flag}_value"
    repeats = df.filter(c.isNotNull()).groupBy(c.alias(value)).agg(F.count("*").alias("__n")).filter("__n > 1").select(value, F.lit(True).alias(rule.flag))
    return df.join(repeats, c == F.col(value), "left").drop(value).withColumn(rule.flag, F.coalesce(rule.flag, F.lit(False)))


def flagged(df: DataFrame, rules: list[Rule]) -> DataFrame:
    rules = [r for r in rules if r.by_row]
    for r in rules:
        if r.rule_type == "unique":
            df = with_repeats(df, r)
    plain = {r.flag: broken(df, r) for r in rules if r.rule_type != "unique"}
    return df.withColumns(plain) if plain else df


def rejection_reason(rules: list[Rule]) -> Column:
    """The labels of all broken quarantine rules, in the order of their ids."""
    return F.concat_ws(", ", *(F.when(F.col(r.flag), F.lit(r.label)) for r in sorted(rules, key=lambda r: r.id)))


def _newest(df: DataFrame, name: str) -> Column:
    """Epoch seconds of the newest value; integers are seconds already."""
    c = F.col(f"`{name}`")
    return F.max(c if isinstance(df.schema[name].dataType, T.IntegralType) else F.unix_micros(c.cast("timestamp")) / 1e6)


def evaluate(df: DataFrame, rules: list[Rule], now: float | None = None) -> QualityReport:
    """Evaluates all rules, then raises QualityFailure if one of severity fail is broken. The flags are persisted until the caller unpersists ``accepted``'s source."""
    now = time.time() if now is None else now
    rules = [checked(df, r) for r in sorted(rules, key=lambda r: r.id)]
    row_rules = [r for r in rules if r.by_row]
    diverting = [r for r in row_rules if r.severity == "quarantine"]
    marks = flagged(df, rules)
    reject = F.greatest(F.lit(False), *(F.col(r.flag) for r in diverting)) if diverting else F.lit(False)
    times = [r for r in rules if r.rule_type == "freshness"]
    got = marks.agg(F.count("*").alias("n"), F.count_if(reject).alias("rejected"), *(F.count_if(r.flag).alias(r.flag) for r in row_rules), *(_newest(df, r.column).cast("double").alias(r.flag) for r in times)).first()
    results = []
    for r in rules:
        p = r.params()
        if r.by_row:
            results.append(RuleResult(r, got[r.flag] == 0, got[r.flag]))
        elif r.rule_type == "row_count":
            ok = p.get("minimum", -math.inf) <= got.n <= p.get("maximum", math.inf)
            results.append(RuleResult(r, ok, 0 if ok else got.n, f"{got.n} rows"))
        else:
            newest = got[r.flag]
            ok = newest is not None and now - newest <= p["max_age_minutes"] * 60
            results.append(RuleResult(r, ok, 0 if ok else got.n, "no value" if newest is None else f"{(now - newest) / 60:.0f} minutes old"))
    flags = [r.flag for r in row_rules]
    accepted = (marks.filter(~reject) if diverting else marks).drop(*flags)
    rejected = marks.filter(reject).withColumn("_rejection_reason", rejection_reason(diverting) if diverting else F.lit("")).drop(*flags)
    report = QualityReport(got.n, results, accepted, rejected, got.rejected, flags)
    failed = [x.rule.label for x in results if not x.passed and x.rule.severity == "fail"]
    if failed:
        raise QualityFailure(f"broken: {', '.join(failed)}", report)
    return report
