import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import quality, scd2, star
from tidemark.operators.quality import Rule


def rule(i, kind, severity="quarantine", column="score", **p):
    return Rule(i, kind, severity, column, json.dumps(p) if p else None)


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame([("c1", 10.0, "rio"), ("c2", 200.0, "recife"), ("c3", 50.0, "!!!"), (None, 50.0, "manaus"), ("c4", float("nan"), "rio\n"), ("c5", None, None)], "customer_id string, score double, city string")


def test_rules(scores):
    rules = [
        rule(1, "not_null", column="customer_id"), rule(2, "range", minimum=0, maximum=100), rule(3, "regex", column="City", pattern="^[a-z]+$"), rule(4, "allowed_values", "warn", "city", values=["rio", None]),
        rule(5, "unique", "warn"), rule(6, "row_count", "quarantine", None, maximum=3), rule(7, "range", "warn", minimum=60),
    ]
    report = quality.evaluate(scores, rules)
    assert {r.rule.id: r.failed_rows for r in report.results} == {1: 1, 2: 1, 3: 2, 4: 4, 5: 2, 6: 6, 7: 3}
    assert rows(report.rejected.select("customer_id", "_rejection_reason")) == sorted([("c2", "range:score"), ("c3", "regex:city"), (None, "not_null:customer_id"), ("c4", "regex:city")], key=repr)
    assert rows(report.accepted.select("customer_id")) == [("c1",), ("c5",)] and report.rejected_rows == 4
    assert report.accepted.columns == scores.columns


def test_unique_counts_no_nulls_and_splits_hot_values(spark):
    """A column that is null or one value in most rows: nulls break nothing, every row of the value does."""
    df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, None).when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("v"), F.lit(1).alias("__value"))
    report = quality.evaluate(df, [Rule(1, "unique", "quarantine", "v"), Rule(2, "unique", "warn", "id"), rule(3, "row_count", "warn", None, minimum=1, maximum=None)])
    hot = df.filter("v = -1").count()
    assert [r.failed_rows for r in report.results] == [hot, 0, 0] and report.rejected.count() == hot and report.accepted.filter("v is null").count() == 10_000
    assert report.accepted.columns == df.columns
    plan = quality.flagged(df, [Rule(1, "unique", "warn", "v")])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_freshness(spark):
    now = datetime(2024, 1, 2, tzinfo=UTC).timestamp()
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23), 0), (None, None)], "t timestamp, n long")
    fresh = lambda d, c, m: quality.evaluate(d, [rule(1, "freshness", "warn", c, max_age_minutes=m)], now).results[0].passed
    assert fresh(df, "t", 61) and not fresh(df, "t", 59) and not fresh(df, "n", 60) and not fresh(df.limit(0), "t", 60)


def test_fail_comes_after_all_results(scores):
    with pytest.raises(quality.QualityFailure) as e:
        quality.evaluate(scores, [rule(1, "not_null", "fail", "customer_id"), rule(2, "range", "warn", minimum=0)])
    assert len(e.value.report.results) == 2


@pytest.mark.parametrize("bad", [rule(1, "custom_sql", sql="x"), rule(1, "nope"), rule(1, "range"), rule(1, "regex", pattern="["), rule(1, "not_null", column="absent"), Rule(1, "range", "warn", "score", "[1]"), Rule(1, "range", "warn", "score", "{")])
def test_misconfigured_rules(scores, bad):
    with pytest.raises(quality.RuleError):
        quality.evaluate(scores, [bad])


def at(day):
    return datetime(2024, 1, day, tzinfo=UTC)


HISTORY = "customer_id string, city string, updated_at timestamp"


def apply(spark, history, batch, day, tombstones=True):
    df = spark.createDataFrame(batch, HISTORY)
    effective = scd2.effective_time(df, "updated_at", F.lit(at(day)))
    if history is None:
        return scd2.with_history(df, ["customer_id"], effective), None
    marked = scd2.classified(history, df, ["customer_id"], effective, F.lit(at(day)), tombstones)
    return scd2.rewritten(history, marked), scd2.outcome(marked)


def shown(df):
    return rows(df.select("customer_id", "city", F.dayofmonth("valid_from"), F.dayofmonth("valid_to"), "is_current", "is_deleted"))


def test_history_of_five_batches(spark):
    h, _ = apply(spark, None, [("a", "rio", at(1)), ("b", "sul", at(1)), (None, "x", at(1))], 1)
    h, o = apply(spark, h, [("a", "norte", at(3)), ("c", "new", at(3)), (None, "x", at(1))], 3)
    assert o == scd2.Outcome(opened=3, closed=2, tombstoned=1, unchanged=1)
    h, o = apply(spark, h, [("a", "late", at(2)), ("b", "back", at(2)), ("c", "new", at(3)), (None, "x", at(1))], 5)
    assert o == scd2.Outcome(opened=1, closed=1, unchanged=2, late_skipped=1)
    assert [r for r in shown(h) if r[0] in ("a", "b")] == [
        ("a", "norte", 3, None, True, False), ("a", "rio", 1, 3, False, False), ("b", "back", 3, None, True, False), ("b", "sul", 1, 3, False, False), ("b", "sul", 3, 3, False, True),
    ]
    again, o = apply(spark, h, [("a", "norte", at(3)), ("b", "back", at(2)), ("c", "new", at(3)), (None, "x", at(1))], 6)
    assert not o.changed
    current = h.filter("is_current").groupBy("customer_id").count().filter("count <> 1")
    assert current.count() == 0
    with pytest.raises(ValueError, match="added"):
        scd2.guard_schema(h, spark.createDataFrame([], HISTORY + ", extra int"))


def test_dimension_and_fact(spark):
    c = spark.createDataFrame([("c1", "rio"), ("c2", "sul")], "customer_id string, city string")
    dim = star.dimension(c, "Customers", ["customer_id"])
    assert dim.columns[0] == "customers_key" and dim.filter("customers_key = 0").count() == 1 and dim.select("customers_key").distinct().count() == 3
    f = spark.createDataFrame([(1, "c1", "c2"), (2, "c9", None)], "id int, buyer string, payer string")
    out, names = star.fact(f, [star.Reference("buyer", "customers", c, ["customer_id"]), star.Reference("payer", "customers", c, ["customer_id"])])
    assert names == ["buyer_customers_key", "payer_customers_key"] and star.unresolved(out, names) == {"buyer_customers_key": 1, "payer_customers_key": 1}
    assert star.fact(f, []) == (f, []) or star.fact(f, [])[0].columns == f.columns
    with pytest.raises(ValueError):
        star.look_up(f, star.Reference("buyer", "x", c, ["customer_id", "city"]), None, "k")


def test_as_of_fact(spark):
    v = spark.createDataFrame([("c1", at(3), False, False), ("c1", at(6), False, True), ("c1", at(9), True, False), ("c2", at(5), True, False)], "id string, valid_from timestamp, is_current boolean, is_deleted boolean")
    f = spark.createDataFrame([(1, "c1", at(1)), (2, "c1", at(3)), (3, "c1", at(7)), (4, "c1", at(9)), (5, "c2", at(4)), (6, "c1", None), (7, None, at(9))], "n int, c string, t timestamp")
    out, _ = star.fact(f, [star.Reference("c", "cust", v, ["id"], history=True)], "t")
    keys = {r.n: r.cust_key for r in out.collect()}
    by = {r.valid_from.astimezone(UTC).day: r[-1] for r in star.keyed(v.filter("id = 'c1'"), ["id"], True).collect()}
    # a deletion doesn't end the version before it
    assert keys == {1: 0, 2: by[3], 3: by[3], 4: by[9], 5: 0, 6: by[9], 7: 0}


def test_two_members_of_one_key_are_refused(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "d_key long, n string")
    with pytest.raises(star.KeyCollision, match="d_key 1"):
        star.check_keys(dim, "d_key")
    star.check_keys(dim.filter("n <> 'b'"), "d_key")
