import hashlib
import hmac
from datetime import UTC, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.hashing import hmac_sha256, row_hash, surrogate_key
from tidemark.functions.names import gold_path, layer_path, require_columns, snake_case, snake_columns
from tidemark.operators import cdc, conform, dedupe, privacy, watermark


@pytest.mark.parametrize("raw, want", [("OrderID", "order_id"), ("Customer Name", "customer_name"), ("already_snake", "already_snake"), ("  Weird--Name  ", "weird_name"), ("UPPER", "upper"), ("_run_id", "run_id")])
def test_snake_case(raw, want):
    assert snake_case(raw) == want


def test_collisions(spark):
    with pytest.raises(ValueError, match="order_id"):
        snake_columns(spark.createDataFrame([(1, 2)], "order_id int, OrderID int"))
    assert snake_columns(spark.createDataFrame([(1, 2)], "source int, _source int")).columns == ["source", "_source"]
    with pytest.raises(KeyError, match="a, b"):
        require_columns(spark.range(1), ["a", "b"], "here")


def test_paths():
    assert layer_path("bronze/x", "silver") == "silver/x" and layer_path("other", "gold") == "gold/other"
    assert gold_path("OrderItems", "fact") == "gold/fact_order_items"


def test_conform(spark):
    df = spark.createDataFrame([("  rio\t", 0, 86400, None)], "City string, updated_at long, Birth_date int, n_at string")
    got = conform.conform(df).first()
    assert got.city == "rio" and got.updated_at.astimezone(UTC) == datetime(1970, 1, 1, tzinfo=UTC) and got.birth_date.astimezone(UTC) == datetime(1970, 1, 2, tzinfo=UTC) and got.n_at is None
    kept = conform.drop_restricted(df, {"City": ("sensitive_pii", False), "updated_at": ("sensitive_pii", True)}, ["n_at"])
    assert "City" not in kept.columns and "updated_at" in kept.columns


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 5, "new"), ("b", 2, "only"), (None, None, "n1"), (None, 3, "n2"), ("t", 1, "x"), ("t", 1, "y")], "k string, seq long, v string")
    assert rows(dedupe.latest_per_key(df, ["k"], "seq").select("k", "v")) == sorted([("a", "new"), ("b", "only"), (None, "n2"), ("t", "y")], key=repr)
    assert dedupe.latest_per_key(df.limit(0), ["k"], "seq").count() == 0
    with pytest.raises(KeyError):
        dedupe.latest_per_key(df, ["nope"], "seq")
    plan = dedupe.latest_per_key(df, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)), max_size=25))
def test_latest_per_key_property(spark, data):
    best = {}
    for k, s, v in data:
        rank = (s is not None, s or 0, v)
        best[k] = max(best.get(k, rank), rank)
    df = spark.createDataFrame(data, "k string, s long, v long")
    assert rows(dedupe.latest_per_key(df, ["k"], "s").select("k", "v")) == sorted(((k, r[2]) for k, r in best.items()), key=repr)


def test_hashes(spark):
    df = spark.createDataFrame([("", None, 1), (None, "", 1), ("x", "é", 2)], "a string, b string, n long")
    assert df.select(row_hash(df, ["a", "b"])).distinct().count() == 3
    text = {("", None): "\x1f\x00", (None, ""): "\x00\x1f", ("x", "é"): "x\x1fé"}
    got = {(r.a, r.b): r.k for r in df.select("a", "b", surrogate_key(df, ["a", "b"]).alias("k")).collect()}
    assert got == {k: int(hashlib.sha256(t.encode()).hexdigest()[:16], 16) >> 1 for k, t in text.items()}
    for key in (b"k", b"long" * 40):
        got = [r[0] for r in df.orderBy("n", F.desc_nulls_last("a")).select(hmac_sha256(F.col("a"), key)).collect()]
        assert got == [hmac.new(key, b"", hashlib.sha256).hexdigest(), None, hmac.new(key, b"x", hashlib.sha256).hexdigest()]


def test_masks(spark):
    df = spark.createDataFrame([("anna@example.com", "12345", 3.0), (None, "1234", None)], "e string, p string, d double")
    out, hit = privacy.apply_masks(df, {"e": "hash", "p": "partial", "d": "redact"}, b"k")
    assert hit == ["e", "p", "d"] and out.dtypes == df.dtypes
    got = out.collect()
    assert len(got[0].e) == 32 and got[1].e is None and [r.p for r in got] == ["*2345", "****"] and got[0].d is None
    with pytest.raises(TypeError):
        privacy.apply_masks(df, {"d": "hash"}, b"k")


def test_scan(spark):
    df = spark.createDataFrame([("a@b.co", "111.222.333-44", "rio", 1, "x")] * 3, "contact string, code string, customer_city string, phone int, _hidden_email string")
    got = {p.column: (p.sensitivity, p.masking) for p in privacy.scan(df)}
    assert got == {"contact": ("pii", "hash"), "code": ("sensitive_pii", "hash"), "customer_city": ("internal", "none"), "phone": ("pii", "redact")}


def test_masking_key(monkeypatch):
    assert privacy.masking_key(None, "development") == privacy.DEV_KEY
    with pytest.raises(KeyError):
        privacy.masking_key("NOT_SET_HERE", "production")
    monkeypatch.setenv("MY_KEY", "s")
    assert privacy.masking_key("MY_KEY", "production") == b"s"


def test_watermarks(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), "a"), (None, None, None)], "i long, t timestamp, s string")
    assert [watermark.kind_of(df, c) for c in "its"] == ["integer", "timestamp", "string"]
    for c, v in (("i", 5), ("s", "x"), ("t", datetime(2024, 1, 1, tzinfo=UTC))):
        assert watermark.decode(watermark.encode(v), watermark.kind_of(df, c)) == v
    assert watermark.with_grace(100, 20, "integer") == 80 and watermark.with_grace("x", 20, "string") == "x" and watermark.with_grace(None, 5, "integer") is None and watermark.with_grace(5, None, "integer") == 5
    assert watermark.newer_than(df, "i", None).count() == 2 and watermark.newer_than(df, "i", 0).count() == 1
    with pytest.raises(KeyError):
        watermark.newer_than(df, "nope", 0)


def test_incremental_filter_is_pushed_down(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/p")
    plan = watermark.newer_than(spark.read.parquet(f"{tmp_path}/p"), "id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan


def test_cdc_merge(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    changes = spark.createDataFrame([("a", 9, "U"), ("b", 9, "D"), ("c", 9, "I"), ("d", 9, "D"), (None, 7, None), ("e", 9, None)], "k string, v int, op string")
    out = cdc.merged(target, changes, ["k"], "op", "D")
    assert rows(out.select("k", "v", "__action").filter("__action not in ('delete', 'ignore')")) == sorted([("a", 9, "update"), ("c", 9, "insert"), ("e", 9, "insert"), (None, 7, "update")], key=repr)
    up, gone = cdc.split(changes, "op", "D")
    assert (up.count(), gone.count()) == (4, 2) and cdc.split(changes, None, "D")[1].count() == 0
    with pytest.raises(KeyError):
        cdc.split(changes, "nope", "D")
