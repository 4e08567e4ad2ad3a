import json
import sqlite3
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.control import contracts, drift
from tidemark.control.store import TABLES, ControlStore
from tidemark.plans import audit, bronze, classify, replay, runner, silver
from tidemark.plans.bronze import Lake
from tidemark.plans.lineage import Lineage
from tidemark.operators.privacy import Proposal
from tidemark.sources.seed import Seed
from tidemark.sources.source import FilteringSource, FrameSource, IncrementalSource, ParquetSource, Source
from tidemark.storage import maintenance
from tidemark.storage.keyed import KeyedTable, LayoutError
from tidemark.storage.table import CommitConflict, VersionedTable
from tidemark.streaming.ingest import append_stream, parquet_stream


@pytest.fixture
def store():
    s = ControlStore()
    s.migrate()
    return s


@pytest.fixture
def lake(spark, store, tmp_path):
    return Lake(spark, f"file://{tmp_path}/lake", store, Lineage(str(tmp_path / "lineage.jsonl")))


def entry(lake, name="orders", strategy="full", keys="id", **kw):
    runner.register(lake.store, "sys", [runner.CatalogEntry(name, strategy, keys, **kw)])
    return next(o for o in lake.store.objects() if o.object_name == name)


# -- control store ------------------------------------------------------------------------------


def test_constraints(store):
    assert len(TABLES) == 11 and store.migrate() == [] and store.version() == 2
    sid = store.insert("source_system", name="s", kind="file")
    base = {"source_system_id": sid, "schema_name": "p", "object_name": "o", "target_path": "bronze/o"}
    for bad in ({"load_strategy": "nope"}, {"load_strategy": "incremental"}, {"load_strategy": "cdc"}, {"load_strategy": "full", "gold_role": "dimension"}, {"load_strategy": "full", "gold_role": "x"}):
        with pytest.raises(sqlite3.IntegrityError):
            store.insert("source_object", **base, **bad)
    oid = store.insert("source_object", **base, load_strategy="full")
    with pytest.raises(sqlite3.IntegrityError):
        store.insert("column_metadata", source_object_id=oid, column_name="c", sensitivity="none", masking_strategy="hash")
    with pytest.raises(sqlite3.IntegrityError):
        store.insert("gold_reference", fact_object_id=oid, dimension_object_id=oid, fact_column="x")
    store.insert("dq_rule", source_object_id=oid, rule_type="unique", severity="warn")
    with store.db:
        store.db.execute("DELETE FROM source_system")
    assert store.rows("SELECT * FROM dq_rule") == []


def test_legacy_store_is_stamped(tmp_path):
    from tidemark.control.store import ddl

    s = ControlStore(str(tmp_path / "c.db"))
    s.db.executescript(ddl())
    assert s.version() == 1 and s.migrate(check=True) == [2] and s.migrate() == [2]


# -- storage --------------------------------------------------------------------------------------


def test_versions_append_restore_and_conflict(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    assert t.version() == -1 and not t.exists()
    t.overwrite(spark.range(3).toDF("a"))
    t.append(spark.range(2).toDF("a"))
    with pytest.raises(ValueError, match="merge_schema"):
        t.append(spark.createDataFrame([(1, "x")], "a long, b string"))
    t.append(spark.createDataFrame([(1, "x")], "a long, b string"), merge_schema=True)
    with pytest.raises(ValueError, match="not string"):
        t.append(spark.createDataFrame([("1",)], "a string"), merge_schema=True)
    assert [t.read(v).count() for v in (0, 1, 2)] == [3, 5, 6] and t.read().columns == ["a", "b"]
    with pytest.raises(CommitConflict):
        t.commit(1, "late", t.read().schema, [])
    t.restore(0)
    assert t.version() == 2
    t.restore(0, dry_run=False)
    assert t.read().count() == 3 and t.read(2).count() == 6
    assert t.version_at(t.history()[1].ts) == 1
    with pytest.raises(LookupError):
        t.version_at(0)
    with pytest.raises(FileNotFoundError):
        t.read(99)
    t.overwrite(spark.range(0).toDF("a"))
    assert t.read().count() == 0


def test_maintenance(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    for i in range(4):
        t.append(spark.range(i * 100, i * 100 + 100).select("id", (F.col("id") % 7).alias("k")).coalesce(1))
    stats = maintenance.file_stats(t)
    assert stats.files == stats.small == 4
    maintenance.compact(t)
    assert maintenance.file_stats(t).files == 1 and t.read().count() == 400
    v = t.version()
    assert maintenance.compact(t) == v  # nothing left to merge
    maintenance.zorder(t, ["id"], files=4)
    assert t.read_range("id", 10, 20).count() == 11
    hit = [f for f in t.manifest().files if f.stats["id"][0] <= 20 and f.stats["id"][1] >= 10]
    assert 0 < len(hit) < len(t.manifest().files)
    with pytest.raises(ValueError, match="nope"):
        maintenance.zorder(t, ["nope"])
    with pytest.raises(ValueError):
        maintenance.vacuum(t, hours=1)
    assert maintenance.vacuum(t) == []
    dead = maintenance.vacuum(t, hours=-1, enforce=False)
    assert dead and t.read(0).count() == 100
    maintenance.vacuum(t, hours=-1, enforce=False, dry_run=False)
    assert t.read().count() == 400
    with pytest.raises(ValueError, match="quarantined"):
        maintenance.vacuum(VersionedTable(spark, f"file://{tmp_path}/quarantine/x"))
    assert [p.rsplit("/", 1)[-1] for p in maintenance.tables_under(spark, f"file://{tmp_path}")] == ["t"]


# -- bronze ---------------------------------------------------------------------------------------


def test_sources(spark, lake, tmp_path):
    obj = entry(lake, strategy="incremental", incremental_column="u")
    with pytest.raises(FileNotFoundError, match="orders"):
        ParquetSource(spark, f"file://{tmp_path}").read(obj)
    assert isinstance(FrameSource({}), Source) and isinstance(FilteringSource(FrameSource({})), IncrementalSource) and not isinstance(FrameSource({}), IncrementalSource)


def test_full_load_and_drift(spark, lake):
    obj = entry(lake)
    load = lambda df: bronze.full_load(lake, FrameSource({"orders": df}), obj, rid)
    with lake.store.run("t") as rid:
        assert load(spark.createDataFrame([(1, "a")], "id long, city string")).rows_written == 1
        load(spark.createDataFrame([(1, "a", "s")], "id long, city string, state string"))
        with pytest.raises(drift.SchemaDriftError):
            load(spark.createDataFrame([(1,)], "id long"))
        with pytest.raises(drift.SchemaDriftError):
            load(spark.createDataFrame([("1", "a", "s")], "id string, city string, state string"))
    table = lake.table(obj.target_path)
    assert table.version() == 1 and {"_ingested_at", "_run_id", "_source"} <= set(table.read().columns) and bronze.latest_run_id(table.read()) == rid
    assert [r["version"] for r in lake.store.rows("SELECT version FROM schema_version WHERE is_current = 1")] == [2]
    assert lake.store.derived_status(rid) == "failed" and [e["event"] for e in lake.lineage.events()] == ["START", "COMPLETE"] * 2 + ["START", "FAIL"] * 2


def test_incremental_load(spark, lake):
    obj = entry(lake, strategy="incremental", incremental_column="u")
    lake.store.update("source_object", {"id": obj.id}, watermark_grace=20)
    obj = lake.store.object(obj.id)
    load = lambda data: bronze.incremental_load(lake, FrameSource({"orders": spark.createDataFrame(data, "id long, u long")}), obj, rid)
    mark = lambda: lake.store.one("SELECT * FROM load_watermark")
    with lake.store.run("t") as rid:
        assert load([]).version == -1 and mark() is None
        r = load([(1, 100), (2, 50), (3, None)])
        assert (r.rows_written, r.watermark_from, r.watermark_to, r.rows_reprocessed) == (3, None, "100", 0)
        r = load([(1, 100), (4, 90), (5, 80), (6, 130), (7, None)])
        assert (r.rows_written, r.watermark_from, r.watermark_to, r.rows_reprocessed) == (3, "100", "130", 2)
        assert load([(8, 5)]).rows_written == 0 and mark()["watermark_value"] == "130"
    assert lake.table(obj.target_path).read().count() == 6
    moment = datetime.fromtimestamp(60, UTC)
    assert replay.rewind(lake.store, obj, moment) == ("130", "60") and mark()["watermark_value"] == "130"
    replay.rewind(lake.store, obj, moment, dry_run=False)
    assert mark()["watermark_value"] == "60"
    assert replay.parse_moment("2024-01-02") == datetime(2024, 1, 2, tzinfo=UTC)


def test_crash_before_the_commit_leaves_the_watermark(spark, lake, monkeypatch):
    obj = entry(lake, strategy="incremental", incremental_column="u")
    source = FrameSource({"orders": spark.createDataFrame([(1, 7)], "id long, u long")})
    monkeypatch.setattr(VersionedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError), lake.store.run("t") as rid:
        bronze.incremental_load(lake, source, obj, rid)
    assert lake.store.one("SELECT * FROM load_watermark") is None
    assert lake.store.one("SELECT * FROM task_run")["error_message"] == "OSError: disk" and lake.store.one("SELECT * FROM pipeline_run")["status"] == "failed"


def test_cdc_load(spark, lake):
    obj = entry(lake, strategy="cdc", incremental_column="seq")
    lake.store.update("source_object", {"id": obj.id}, cdc_operation_column="op")
    obj = lake.store.object(obj.id)
    load = lambda data: bronze.cdc_load(lake, FrameSource({"orders": spark.createDataFrame(data, "id string, city string, op string, seq long")}), obj, rid)
    with lake.store.run("t") as rid:
        r = load([("a", "rio", "I", 1), ("a", "sul", "U", 2), ("b", "x", "D", 1), ("c", "z", None, 1)])
        assert (r.inserted, r.rows_rejected) == (2, 1)
        r = load([("a", "norte", "U", 3), ("c", "z", "D", 2), ("d", "n", "I", 1), ("e", "n", "D", 1)])
        assert (r.inserted, r.updated, r.deleted, r.rows_written) == (1, 1, 1, 3)
        with pytest.raises(ValueError):
            bronze.full_load(lake, FrameSource({}), obj, rid)
    assert rows(lake.table(obj.target_path).read().select("id", "city")) == [("a", "norte"), ("d", "n")]


def test_cdc_batches_write_only_touched_buckets(spark, lake, monkeypatch):
    monkeypatch.setattr(KeyedTable.__init__, "__defaults__", (10,))
    obj = entry(lake, strategy="cdc", incremental_column="seq")
    load = lambda data: bronze.cdc_load(lake, FrameSource({"orders": spark.createDataFrame(data, "id long, city string, seq long")}), obj, rid)
    with lake.store.run("t") as rid:
        load([(i, "a", 1) for i in range(100)])
        first = {f.path for f in lake.table(obj.target_path).manifest().files}
        assert (load([(5, "b", 2), (5, "c", 3)]).updated, load([]).rows_written) == (1, 0)
    m = lake.table(obj.target_path).manifest()
    assert m.metrics["touched"] == 1 and m.metrics["kept"] == 9 and len({f.path for f in m.files} & first) == len(first) - 1
    assert lake.table(obj.target_path).read(0).count() == 100
    assert rows(lake.table(obj.target_path).read().groupBy("city").count()) == [("a", 99), ("c", 1)]
    with pytest.raises(LayoutError):
        KeyedTable(lake.table(obj.target_path), ["city"]).merge(None, lambda d: (d, None), m.struct, "x")


def test_history_batches_keep_closed_versions(spark, lake):
    obj = entry(lake, name="c", strategy="incremental", incremental_column="u", scd2_enabled=True)
    day = lambda n: datetime(2024, 1, n, tzinfo=UTC)
    table = lake.table("silver/c")
    for n, data in enumerate([[(1, "a", day(1)), (2, "a", day(1))], [(1, "b", day(2))], [(1, "b", day(3))], [(1, "c", day(4)), (3, "z", day(4))]]):
        with lake.store.run("t") as rid:
            bronze.incremental_load(lake, FrameSource({"c": spark.createDataFrame(data, "id long, v string, u timestamp")}), obj, rid)
            before = table.manifest().files if n else []
            silver.build(lake, obj, rid)
            assert {f.path for f in before if f.bucket is None} <= {f.path for f in table.manifest().files}
    got = rows(table.read().select("id", "v", "is_current", F.dayofmonth("valid_from"), F.dayofmonth("valid_to")))
    assert got == [(1, "a", False, 1, 2), (1, "b", False, 2, 3), (1, "b", False, 3, 4), (1, "c", True, 4, None), (2, "a", True, 1, None), (3, "z", True, 4, None)]
    assert table.read(2).count() == 4


# -- contracts --------------------------------------------------------------------------------------

CONTRACT = """
version: 1
source_system: sys
object: orders
owner: team
freshness_sla_minutes: 60
freshness_column: u
columns:
  - {name: id, type: int64, nullable: false, expect: {unique: true, severity: fail}}
  - {name: score, type: int64, expect: {minimum: 0, maximum: 100, severity: quarantine}}
  - {name: city, type: string, expect: {allowed_values: [rio], pattern: "^r"}}
  - {name: u, type: int64, null_severity: fail}
"""


def test_contracts(spark, lake, tmp_path):
    entry(lake)
    (tmp_path / "a.yml").write_text(CONTRACT)
    c = contracts.load(tmp_path)[0]
    assert [r["rule_type"] for r in c.rules()] == ["not_null", "unique", "range", "allowed_values", "regex", "freshness"]
    lake.store.insert("dq_rule", source_object_id=1, rule_type="unique", severity="warn", column_name="by_hand")
    assert contracts.sync(lake.store, c) == contracts.sync(lake.store, c) == 6
    assert lake.store.one("SELECT count(*) AS n FROM dq_rule")["n"] == 7 and lake.store.objects()[0].owner == "team"
    df = spark.createDataFrame([], "id long, score string, city string, more int")
    assert contracts.conformance(c, df) == ["u is missing", "score is string, not int64"]
    (tmp_path / "b.yml").write_text(CONTRACT)
    with pytest.raises(contracts.ContractError, match="already"):
        contracts.load(tmp_path)
    for broken in ("columns: []", "owner: x\nextra: 1", "version: 2"):
        (tmp_path / "b.yml").write_text(f"source_system: s\nobject: o\n{broken}")
        with pytest.raises(contracts.ContractError, match="b.yml"):
            contracts.load(tmp_path / "b.yml")
    for bad in ({}, {"minimum": 2, "maximum": 1}, {"unique": True, "severity": "x"}):
        with pytest.raises(contracts.ContractError):
            contracts.Expectation(**bad)


# -- whole runs ---------------------------------------------------------------------------------------


def test_pipeline_over_the_seeded_shop(spark, lake, tmp_path):
    Seed(spark, 400).write(f"file://{tmp_path}/seed")
    ids = runner.register(lake.store, "shop", runner.SHOP)
    assert runner.register(lake.store, "shop", runner.SHOP) == ids
    lake.store.insert("dq_rule", source_object_id=ids["order_items"], rule_type="range", column_name="price", severity="quarantine", expression=json.dumps({"maximum": 400}))
    classify.apply_proposals(lake.store, lake.store.object(ids["customers"]), [Proposal("customer_email", "pii", "hash", "e"), Proposal("customer_document", "sensitive_pii", "hash", "d")])
    source = ParquetSource(spark, f"file://{tmp_path}/seed")
    report = runner.run_pipeline(lake, source)
    assert report.failures == 0, str(report)
    assert lake.store.one("SELECT status FROM pipeline_run")["status"] == "quarantined"
    customers = lake.table("gold/dim_customers").read()
    assert "customer_document" not in customers.columns and customers.count() == 41
    assert all(len(r[0]) == 32 for r in customers.filter("customers_key <> 0").select("customer_email").collect())
    items = lake.table("gold/fact_order_items").read()
    assert {"products_key", "sellers_key"} <= set(items.columns) and items.filter("products_key = 0").count() == 0 and items.agg(F.max("price")).first()[0] <= 400
    assert lake.table("quarantine/order_items").read().count() > 0
    resumed = runner.run_pipeline(lake, source, run_id=report.run_id)
    assert {s.status for s in resumed.steps} == {"skipped"}
    order = runner.asset_order(lake.store)
    assert order.index("gold.customers") < order.index("gold.orders")

    views = audit.Audit(audit.frames(spark, lake.store))
    for name, df in views.snapshot(datetime.now(UTC)).items():
        df.collect()
    assert {r.layer for r in views.run_summary(report.run_id).collect()} == {"bronze", "silver", "gold"}
    assert views.privacy_posture().filter("reaches_gold = 'no'").count() == 1
    assert "== freshness" in audit.report(views)
    # a failing source doesn't stop the others
    half = runner.run_bronze(lake, FrameSource({"products": source.read(lake.store.object(ids["products"]))}))
    assert half.failures == 4 and sum(s.status == "succeeded" for s in half.steps) == 1
    lake.store.insert("pipeline_run", run_id="stuck", pipeline_name="x", status="running", started_at="2020-01-01T00:00:00+00:00")
    assert [r["status"] for r in audit.close_abandoned(spark, lake.store, dry_run=False)] == ["failed"]


def test_stream_appends_each_batch_once(spark, tmp_path):
    for i in range(2):
        spark.range(i * 5, i * 5 + 5).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    for _ in range(2):
        append_stream(parquet_stream(spark, f"{tmp_path}/in", spark.range(1).schema, 1), table, f"{tmp_path}/cp").awaitTermination()
    assert table.read().count() == 10 and table.version() == 1


def test_streams_into_one_table_have_their_own_numbers(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    for name in ("a", "b"):
        spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        for _ in range(2):
            append_stream(parquet_stream(spark, f"{tmp_path}/{name}", spark.range(1).schema, 1), table, f"{tmp_path}/cp-{name}").awaitTermination()
    assert table.read().count() == 20
    table.append(spark.range(10).toDF("id"), batch=(f"{tmp_path}/cp-a", 0))  # a replay of a committed batch
    assert table.read().count() == 20 and table.version() == 1


def test_intermediate_folders_go(spark):
    from tidemark import runtime
    from tidemark.storage.fs import Files

    df = runtime.materialise(spark.range(5), "some")
    folder = runtime.work_dir(spark)
    assert df.count() == 5 and Files(spark, folder).walk(folder)
    runtime.clean(spark)
    assert not Files(spark, folder).exists(folder)
    assert runtime.materialise(spark.range(5), "some").count() == 5


def test_shared_folder(spark, monkeypatch):
    from tidemark import runtime

    class Conf:
        def get(self, *_):
            return None

    class Context:
        applicationId, master = "an-app", "spark://cluster"
        getConf = staticmethod(lambda: Conf())

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        runtime.shared_dir(Session())
    Context.master = "local[2]"
    assert runtime.shared_dir(Session()).startswith("file:///")
    assert runtime.shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or runtime.shared_dir(spark))
