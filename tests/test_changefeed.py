import random

import pytest

from tests.conftest import rows
from tidemark.operators.changefeed import BucketedTable, normalised

CHANGES = "no long, o long, id string, st string, op string, kind string, seq long, payload string, key string, at timestamp"
SETTINGS = [(1, "id", "op", "D", "seq"), (2, "id, st", "kind", "removed", "seq"), (3, "id", None, "D", "seq"), (4, "id,nowhere", "nowhere", "D", "seq")]


def settings(spark):
    return spark.createDataFrame(SETTINGS, "object long, primary_key_columns string, cdc_operation_column string, cdc_delete_value string, incremental_column string")


def prepared(spark, changes):
    df = spark.createDataFrame([(*c, "p", "k", None) for c in changes], CHANGES)
    return normalised(df, settings(spark), obj="o", number="no", arrived_at="at")


def brute(changes):
    conf = {o: (tuple(k.strip() for k in keys.split(",")), op, d) for o, keys, op, d, _ in SETTINGS}
    first = {}
    for no, o, i, st, op, kind, seq in changes:
        body = (o, i, st, op, kind, seq)
        first[body] = min(first.get(body, no), no)
    best = {}
    for (o, i, st, op, kind, seq), no in first.items():
        if o not in conf:
            continue
        keys, opcol, d = conf[o]
        have = {"id": i, "st": st, "op": op, "kind": kind}
        word = have.get(opcol)
        gone = word is not None and word.strip().lower() == d.strip().lower()
        k = (o, tuple(have.get(x) for x in keys))
        rank = (seq is not None, seq or 0, no)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, no, gone)
    return sorted(((o, no) for (o, _), (_, no, gone) in best.items() if not gone), key=repr)


@pytest.mark.parametrize("cuts", [[], [150], [50, 51, 250]])
def test_any_batches_give_the_same(spark, tmp_path, cuts):
    r = random.Random(7)
    words = ["D", " d", "U", None, "removed", "Removed ", "I"]
    changes = [(i, r.choice([1, 1, 2, 3, 4, 9]), r.choice(["a", "b", "c", None, ""]), r.choice(["x", "y", None]), r.choice(words), r.choice(words), r.choice([None, *range(40)])) for i in range(300)]
    changes += [(1000 + i, *c[1:]) for i, c in enumerate(r.sample(changes, 60))]  # repeats that come later
    t = BucketedTable(spark, f"file://{tmp_path}/t", 3)
    for a, b in zip([0, *cuts], [*cuts, len(changes)], strict=True):
        t.apply(prepared(spark, changes[a:b]))
    assert rows(t.current().select("object", "change_no")) == brute(changes)


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = BucketedTable(spark, f"file://{tmp_path}/t", 13)
    t.apply(prepared(spark, [(i, 1, f"k{i}", "x", "U", None, 1) for i in range(200)]))
    before = {f.path: f.bucket for f in t.table.manifest().files}
    t.apply(prepared(spark, [(999, 1, "k7", "x", "D", None, 2)]))
    after = {f.path: f.bucket for f in t.table.manifest().files}
    assert len({b for p, b in after.items() if p not in before}) == 1
    assert t.current().count() == 199 and t.table.read(0).count() == 200


def test_empty_batch_commits_nothing(spark, tmp_path):
    t = BucketedTable(spark, f"file://{tmp_path}/t")
    assert t.apply(prepared(spark, [])) == -1
    t.apply(prepared(spark, [(1, 1, "a", None, None, None, None)]))
    assert t.apply(prepared(spark, [])) == 0 and t.current().count() == 1


def test_applying_a_batch_twice_changes_nothing(spark, tmp_path):
    t = BucketedTable(spark, f"file://{tmp_path}/t")
    batch = [(1, 1, "a", None, "U", None, 5), (2, 1, "b", None, "D", None, 5), (3, 1, "b", None, "U", None, 4)]
    t.apply(prepared(spark, batch))
    once = rows(t.current())
    t.apply(prepared(spark, batch))
    assert rows(t.current()) == once


def test_layout_is_the_tables_own(spark, tmp_path):
    """Neither another argument nor another setting on reopening moves a key."""
    changes = [(i, 1 + i % 2, f"k{i}", "x", "U", None, 1) for i in range(40)]
    BucketedTable(spark, f"file://{tmp_path}/t", 5).apply(prepared(spark, changes))
    reopened = BucketedTable(spark, f"file://{tmp_path}/t", 1000)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        reopened.apply(prepared(spark, [(100 + i, 1 + i % 2, f"k{i}", "x", "U", "y", 2) for i in range(40)]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert reopened.current().count() == 40 and reopened.current().filter("change_no >= 100").count() == 40
    before = reopened.layout()
    assert {n for _, n in before.values()} == {4}
    reopened.apply(prepared(spark, [(200, 4, "new", None, None, None, 1)]))
    assert {k: v for k, v in reopened.layout().items() if k != "4"} == before and reopened.layout()["4"] == [8, 1]
    reopened.rebucket()
    assert {n for _, n in reopened.layout().values()} == {1} and reopened.current().count() == 41
    reopened.apply(prepared(spark, [(300, 1, "k0", None, "D", None, 9)]))
    assert reopened.current().count() == 40


def test_batch_of_one_object_leaves_the_others(spark, tmp_path):
    t = BucketedTable(spark, f"file://{tmp_path}/t")
    t.apply(prepared(spark, [(i, 1 + i % 3, f"k{i}", "x", "U", None, 1) for i in range(30)]))
    t.apply(prepared(spark, [(99, 2, "k1", "x", "U", None, 2)]))
    assert t.table.manifest().metrics == {"touched": 1, "kept": 2}


def test_a_moved_table_can_be_read(spark, tmp_path):
    t = BucketedTable(spark, f"file://{tmp_path}/t")
    t.apply(prepared(spark, [(1, 1, "a", None, None, None, None)]))
    (tmp_path / "t").rename(tmp_path / "u")
    assert BucketedTable(spark, f"file://{tmp_path}/u").current().count() == 1
