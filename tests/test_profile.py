import math
import random
import statistics
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import profile
from tidemark.operators.profile import ColumnSpec, ValueCountStore, value_counts


def specs():
    return [ColumnSpec("n", "number", F.col("n") < 0), ColumnSpec("k", "category"), ColumnSpec("x")]


def frame(spark, data):
    return spark.createDataFrame(data, "load_no long, n long, k string, x string, value string, scope string")


def test_figures_against_brute_force(spark):
    r = random.Random(1)
    data = [(r.randrange(4), r.choice([None, 0, -3, r.randrange(10), r.randrange(1 << 50)]), r.choice("ab"), r.choice([None, "", "ü" * 5000, "q"]), "v", "s") for _ in range(600)]
    counts = value_counts(frame(spark, data), "t", "load_no", specs())
    got = {(x.load, x.column_name): x for x in profile.load_profile(counts).collect()}
    for load in range(4):
        own = [d for d in data if d[0] == load]
        n = [d[1] for d in own if d[1] is not None]
        x = got[load, "n"]
        assert (x.n_rows, x.nulls, x.n_distinct, x.min_value, x.max_value) == (len(own), len(own) - len(n), len(set(n)), min(n), max(n))
        assert x.median == statistics.median(n) and x.level == statistics.median([max(v, 0) for v in n])
        assert abs(x.broken_share - sum(v < 0 for v in n) / len(n)) < 1e-9
        assert abs(x.zero_share - n.count(0) / len(n)) < 1e-9
        assert got[load, "x"].n_distinct == len({d[3] for d in own} - {None})


def test_withdrawn_load_leaves_no_trace(spark, tmp_path):
    store = ValueCountStore(spark, f"file://{tmp_path}/s")
    a = frame(spark, [(1, 5, "a", "x", None, None), (1, None, None, None, None, None), (1, 5, "a", "x", None, None)])
    store.apply(a, "t", "load_no", specs())
    before = rows(store.counts())
    store.apply(frame(spark, [(2, 7, "b", "", None, None)]), "t", "load_no", specs())
    store.withdraw("t", [2])
    assert rows(store.counts()) == before
    store.apply(a, "t", "load_no", specs(), sign=-1)
    assert rows(store.counts()) == []
    store.compact()
    assert rows(store.maintained()) == []


def departures(spark, data):
    counts = value_counts(frame(spark, data), "t", "load_no", specs())
    return rows(profile.departures(counts, profile.load_profile(counts), ["k"]).select("load", "column_name", F.concat_ws(",", "reasons")))


def test_departures(spark):
    usual = [(load, i % 50 + 1, "ab"[i % 2], f"x{i}", None, None) for load in range(9) for i in range(100)]
    assert departures(spark, usual) == []
    odd = [(20, None if i < 20 else 1, "a", f"x{i}", None, None) for i in range(100)]
    got = departures(spark, usual + odd)
    assert got == [(20, "k", "value_share"), (20, "n", "distinct,median,null_share")]
    broken = [(21, -1 if i < 6 else i % 50 + 1, "ab"[i % 2], f"x{i}", None, None) for i in range(100)]
    assert departures(spark, usual + broken) == [(21, "n", "form")]
    missing = [(22, i % 50 + 1, "c", f"x{i}", None, None) for i in range(100)]
    assert departures(spark, usual + missing) == [(22, "k", "value_share")]


def test_all_null_and_empty(spark):
    assert departures(spark, []) == []
    x = profile.load_profile(value_counts(frame(spark, [(1, None, None, None, None, None)]), "t", "load_no", specs())).filter("column_name = 'n'").first()
    assert (x.median, x.null_share, x.entropy, x.broken_share) == (None, 1.0, 0.0, None)


def test_even_count_median_is_between(spark):
    data = [(1, v, None, None, None, None) for v in (0, 10, 20, 1 << 40)]
    x = profile.load_profile(value_counts(frame(spark, data), "t", "load_no", specs())).filter("column_name = 'n'").first()
    assert x.median == 15


def one(spark, kind, values):
    df = spark.createDataFrame([(1, v) for v in values], f"load long, c {kind}")
    return profile.load_profile(value_counts(df, "t", "load", [ColumnSpec("c", "number")])).first()


@pytest.mark.parametrize("values", [[1.2, 1.9, -5.5], [0.1, -0.1, 1e300, -1e300, 5e-324, -2.5, 3.0, 0.0], [-1.5, -2.5], [1e-310, 2.0]])
def test_floating_point_numbers_are_exact(spark, values):
    x = one(spark, "double", [*values, None, values[0]])
    given = [*values, values[0]]
    assert (x.n_distinct, x.min_value, x.max_value, x.nulls) == (len(set(values)), min(values), max(values), 1)
    assert x.median == statistics.median(given)


def test_special_doubles(spark):
    x = one(spark, "double", [float("inf"), -0.0, 0.0, float("-inf"), float("nan")])
    assert x.n_distinct == 4 and x.min_value == float("-inf") and math.isnan(x.max_value) and x.median == 0.0 and x.zero_share == 0.4


def test_decimals_dates_and_times(spark):
    x = one(spark, "decimal(12,2)", [Decimal("-1.25"), Decimal("3.10"), Decimal("0.00")])
    assert (x.n_distinct, x.min_value, x.max_value, x.median, x.zero_share) == (3, -1.25, 3.1, 0.0, 1 / 3)
    assert one(spark, "decimal(30,2)", [Decimal("12345678901234567890.25"), Decimal("-1")]).max_value == 12345678901234567890.25
    x = one(spark, "date", [date(1969, 12, 31), date(1970, 1, 3)])
    assert (x.min_value, x.max_value, x.median) == (-1, 2, 0.5)
    assert one(spark, "timestamp_ntz", [datetime(1970, 1, 1, 0, 0, 1)]).median == 1_000_000
    assert one(spark, "long", [-(1 << 62), 7, 1 << 62]).median == 7


def test_rows_without_a_load(spark):
    usual = [(load, i % 50 + 1, "ab"[i % 2], f"x{i}", None, None) for load in range(9) for i in range(100)]
    stray = [(None, None, "z", "q", None, None)] * 40
    assert departures(spark, usual + stray) == []
    counts = value_counts(frame(spark, usual + stray), "t", "load_no", specs())
    assert profile.load_profile(counts).count() == 27
    assert profile.state_profile(counts).filter("column_name = 'n'").first().nulls == 40
