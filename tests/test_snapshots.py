import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import merkle, snapdiff

SCHEMA = "o long, no long, at timestamp, k string, v string, w string, u long, h1 long, rank long"
START = datetime(2024, 1, 1, tzinfo=UTC)


def args(spark, data, objects):
    full = [(o, no, START + timedelta(days=day), k, v, w, u, 1, 2) for o, no, day, k, v, w, u in data]
    return {
        "rows": spark.createDataFrame(full, SCHEMA), "objects": spark.createDataFrame(objects, "o long, incremental boolean"), "obj": "o", "number": "no", "taken_at": "at",
        "key": "k", "updated_at": "u", "compared": [F.col("v"), F.col("w")],
    }


def diff(spark, data, objects):
    return rows(snapdiff.snapshot_changes(**args(spark, data, objects), values=["k"]).select("o", "no", "k", "change_type"))


def versions(spark, data, objects):
    return rows(merkle.history(**args(spark, data, objects), per_leaf=2).select("o", "k", "from_snapshot", "to_snapshot", "is_deleted"))


def brute(data, objects):
    """Cases and versions by plain dictionaries."""
    inc, cases, out = dict(objects), [], []
    for o in sorted({d[0] for d in data}):
        days = sorted({(d[2], d[1]) for d in data if d[0] == o})
        state, opened = {}, {}
        for i, (day, no) in enumerate(days):
            now = {}
            for d in data:
                if d[:3] == (o, no, day):
                    rank = (d[6] is not None, d[6] or 0)
                    if d[3] not in now or rank >= now[d[3]][0]:
                        now[d[3]] = (rank, d[4:6])
            now = {k: v for k, (_, v) in now.items()}
            changed = {k: "added" if k not in state else "changed" for k, v in now.items() if state.get(k, object()) != v}
            if not inc[o]:
                changed |= {k: "removed" for k in state if k not in now}
            for k, c in changed.items():
                if i:
                    cases.append((o, no, k, c))
                if k in opened:
                    out.append((o, k, opened[k][0], no, opened[k][1]))
                opened[k] = (no, c == "removed")
            state = {**state, **now} if inc[o] else now
        out += [(o, k, f, 0, d) for k, (f, d) in opened.items()]
    return sorted(cases, key=repr), sorted(out, key=repr)


def stepwise(spark, root, data, objects, steps):
    """The versions after adding the snapshots of each step (numbers) by runs of their own."""
    a = args(spark, data, objects)
    df, o = a.pop("rows"), a.pop("objects")
    h = merkle.MerkleHistory(spark, f"file://{root}/h", **a, per_leaf=2, per_file=8)
    for numbers in steps:
        h.add(df.filter(F.col("no").isin(numbers)), o)
    return h, rows(h.read().select("o", "k", "from_snapshot", "to_snapshot", "is_deleted"))


def test_runs_one_by_one(spark, tmp_path):
    data, objects = deliveries(3)
    _, history = brute(data, objects)
    h, got = stepwise(spark, tmp_path / "a", data, objects, [[3], [7], [5], [5], [9]])  # 5 comes twice
    assert got == history
    assert len(h.versions.history()) == 4 and h.add(args(spark, data, objects)["rows"], args(spark, data, objects)["objects"])["read"] == 0
    h, got = stepwise(spark, tmp_path / "b", data, objects, [[3, 7], [3, 7, 5, 9]])
    assert got == history
    closed = {f.path for f in h.versions.manifest(0).files if f.bucket is None}
    assert closed and closed <= {f.path for f in h.versions.manifest(1).files}
    with pytest.raises(ValueError, match="older"):
        stepwise(spark, tmp_path / "c", data, objects, [[7], [3]])


@pytest.mark.parametrize("keys", [40, 1000])
def test_any_number_of_files_and_leaves(spark, tmp_path, keys):
    """Leaves and files of many sizes: a quarter of the keys changes, and some go."""
    data = [(1, no, no, f"k{k}", "y" if no == 2 and k % 4 == 0 else "x", None, 1) for no in (1, 2) for k in range(keys) if no == 1 or k % 10 != 9]
    _, got = stepwise(spark, tmp_path, data, [(1, False)], [[1], [2]])
    assert got == brute(data, [(1, False)])[1]


def test_only_differing_leaves_and_their_files_are_touched(spark, tmp_path):
    data = [(1, no, no, f"k{k}", "x" if (no, k) != (2, 7) else "y", None, 1) for no in (1, 2) for k in range(200)]
    h, got = stepwise(spark, tmp_path, data, [(1, False)], [[1], [2]])
    m = h.versions.manifest()
    assert m.metrics["changed"] == 1 and m.metrics["leaves"] >= 50 and 0 < m.metrics["read_bytes"] < m.metrics["kept_bytes"]
    assert len(got) == 201 and (1, "k7", 2, 0, False) in got


def deliveries(seed):
    r = random.Random(seed)
    data, objects = [], [(1, False), (2, True)]
    for o in (1, 2):
        for i, no in enumerate((3, 7, 5, 9)):  # numbers don't follow time
            for k in range(30):
                if r.random() < 0.8:
                    v = r.choice([None, "", "x", "y" * 3000])
                    data.append((o, no, i, f"k{k}" if k else None, v, None, 10))
                    if r.random() < 0.2:
                        data.append(data[-1])  # repeated
                    if r.random() < 0.2:
                        data.append((o, no, i, f"k{k}" if k else None, "stale", None, r.choice([None, 5])))
    return data, objects


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    data, objects = deliveries(seed)
    cases, history = brute(data, objects)
    assert diff(spark, data, objects) == cases
    assert versions(spark, data, objects) == history


def test_null_and_empty_differ_and_columns_dont_mix(spark):
    data = [(1, 1, 0, "a", None, "", 1), (1, 2, 1, "a", "", None, 1), (1, 1, 0, "b", None, "z", 1), (1, 2, 1, "b", "z", None, 1)]
    assert diff(spark, data, [(1, False)]) == [(1, 2, "a", "changed"), (1, 2, "b", "changed")]


def test_empty_and_unknown_object(spark):
    assert diff(spark, [], [(1, False)]) == []
    assert versions(spark, [], []) == []
    assert diff(spark, [(4, 1, 0, "a", "x", None, 1), (4, 2, 1, "b", "x", None, 1)], []) == [(4, 2, "a", "removed"), (4, 2, "b", "added")]


def test_ties_give_one_row_and_both_operators_agree(spark):
    data = [(1, 1, 0, "a", "x", None, 5), (1, 1, 0, "a", "y", None, 5), (1, 2, 1, "a", "x", None, 5), (1, 2, 1, "a", "y", None, 5)]
    assert diff(spark, data, [(1, False)]) == []
    assert versions(spark, data, [(1, False)]) == [(1, "a", 1, 0, False)]


def test_history_has_periods(spark):
    data = [(1, 1, 0, "a", "x", None, 1), (1, 2, 1, "b", "x", None, 1), (1, 3, 2, "a", "x", None, 1)]
    got = merkle.history(**args(spark, data, [(1, False)]), carried=["v"]).filter("k = 'a'").orderBy("from_snapshot").collect()
    assert [(x.from_snapshot, x.to_snapshot, x.is_deleted, x.is_current, x.v) for x in got] == [(1, 2, False, False, "x"), (2, 3, True, False, "x"), (3, 0, False, True, "x")]
    assert all(a.valid_to == b.valid_from for a, b in zip(got, got[1:], strict=False))
