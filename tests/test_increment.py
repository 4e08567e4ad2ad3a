from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.increment import PART, IncrementalResult, first_of_repeats, first_run_after, run_watermarks
from tidemark.storage.table import CommitConflict

T0 = datetime(2024, 1, 1, tzinfo=UTC)


def frame(spark, data):
    return spark.createDataFrame(data, "no long, p string, v string, h long, n long")


def compute(df):
    return df.filter("v <> 'drop'").select("no", "v", PART)


def test_only_changed_partitions_are_recomputed(spark, tmp_path):
    seen = []

    def spy(df):
        seen.append({r[0] for r in df.select(PART).distinct().collect()})
        return compute(df)

    out = IncrementalResult(spark, f"file://{tmp_path}/r")
    base = [(1, "a", "x", None, 1), (2, "b", "y", None, 1), (3, None, "z", None, 1), (4, "c", "w", None, 1)]
    assert out.run(frame(spark, base), F.col("p"), spy)["changed"] == 4
    assert rows(out.read()) == [(1, "x"), (2, "y"), (3, "z"), (4, "w")]
    assert out.run(frame(spark, base), F.col("p"), spy)["changed"] == 0
    later = [(1, "a", "x", None, 1), (1, "a", "x", None, 1), (2, "b", "drop", None, 1), (3, None, "z", None, 1)]
    assert {k: v for k, v in out.run(frame(spark, later), F.col("p"), spy).items() if k != "version"} == {"changed": 2, "vanished": 1}
    assert rows(out.read()) == [(1, "x"), (1, "x"), (3, "z")]
    assert seen == [{"a", "b", "c", "none"}, {"a", "b"}]


def test_crash_before_the_fingerprints_is_repeated_once(spark, tmp_path, monkeypatch):
    out = IncrementalResult(spark, f"file://{tmp_path}/r")
    data = frame(spark, [(1, "a", "x", None, 1), (2, "b", "y", None, 1)])
    monkeypatch.setattr(out.marks, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        out.run(data, F.col("p"), compute)
    monkeypatch.undo()
    assert out.run(data, F.col("p"), compute)["changed"] == 2
    assert rows(out.read()) == [(1, "x"), (2, "y")]


def test_empty_source(spark, tmp_path):
    assert IncrementalResult(spark, f"file://{tmp_path}/r").run(frame(spark, []), F.col("p"), compute)["changed"] == 0


def test_first_of_repeats(spark):
    df = spark.createDataFrame([(2, "a ", None, T0), (1, "a", None, T0), (3, "a", "", T0), (4, "a", None, T0 - timedelta(1))], "no long, c string, s string, at timestamp")
    form = lambda c: F.trim(c) if c == "c" else F.col(c)
    assert [r[0] for r in rows(first_of_repeats(df, ignored=["no", "at"], order=["at", "no"], trimmed=form))] == [3, 4]


def test_first_run_after(spark):
    day = lambda n: T0 + timedelta(days=n)
    data = [(1, 1, day(0)), (2, 1, day(1)), (3, 1, day(1.5)), (4, 1, day(9)), (5, 2, day(0)), (6, 1, day(-40)), (7, None, day(0)), (8, 1, day(5))]
    runs = [(10, 1, day(1)), (11, 1, day(1)), (12, 1, day(5)), (20, 3, day(3))]
    got = first_run_after(
        spark.createDataFrame(data, "row long, o long, at timestamp"), spark.createDataFrame(runs, "run long, o long, st timestamp"), obj="o", arrived="at", started="st", run="run"
    ).select("row", "run")
    assert rows(got) == [(1, 10), (2, 10), (3, 12), (6, 10), (8, 12)]


def test_second_writer_touches_nothing(spark, tmp_path):
    """A run that finds another at work stops before it has replaced a row; a dead run's own retry goes on."""
    root, data = f"file://{tmp_path}/r", frame(spark, [(1, "a", "x", None, 1)])
    other = frame(spark, [(9, "a", "z", None, 1)])
    a, b = IncrementalResult(spark, root, owner="a"), IncrementalResult(spark, root, owner="b")

    def slow(df):
        with pytest.raises(CommitConflict, match="a is writing"):
            b.run(other, F.col("p"), compute)
        return compute(df)

    a.run(data, F.col("p"), slow)
    assert rows(a.read()) == [(1, "x")]
    with pytest.raises(OSError):
        a.run(other, F.col("p"), lambda df: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(CommitConflict):
        b.run(other, F.col("p"), compute)
    assert IncrementalResult(spark, root, owner="a").run(other, F.col("p"), compute)["changed"] == 1
    assert rows(b.read()) == [(9, "z")] and b.run(other, F.col("p"), compute)["changed"] == 0


def test_watermarks_against_brute_force(spark):
    import random

    r = random.Random(5)
    minute = lambda n: T0 + timedelta(minutes=n)
    data = [(i, r.choice([1, 1, 1, 2]), minute(r.randrange(300)), r.choice([None, r.randrange(300)])) for i in range(500)]
    runs = [(100 + i, o, minute(m), 25 if o == 1 else None) for i, (o, m) in enumerate((o, m) for o in (1, 2) for m in sorted(r.sample(range(280), 20)))]
    got = run_watermarks(spark.createDataFrame(data, "row long, o long, at timestamp, v long"), spark.createDataFrame(runs, "run long, o long, st timestamp, g long"), obj="o", arrived="at", started="st", run="run", value="v", grace="g")
    want = []
    for o in (1, 2):
        mark, earlier = None, []
        for run, _, st, g in (x for x in runs if x[1] == o):
            new = [d for d in data if d[1] == o and d[2] <= st and d not in earlier]
            again = 0 if mark is None else sum(d[3] is not None and d[3] > mark - (g or 0) for d in earlier)
            to = max([d[3] for d in new if d[3] is not None] + ([mark] if mark is not None else []), default=None)
            want.append((o, run, mark, to, len(new), again))
            mark, earlier = to, earlier + new
    assert rows(got) == sorted(want, key=repr)
