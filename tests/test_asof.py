import random
from datetime import UTC, datetime

import pytest

from tests.conftest import rows
from tidemark.operators.asof import attributes_at_event, cell_sizes

EVENTS = "id long, who string, t long, u long"
VERSIONS = "no long, who string, vf timestamp, rec timestamp, gone boolean"


def ts(us):
    return None if us is None else datetime.fromtimestamp(us / 1e6, UTC)


def found(spark, events, versions, **kw):
    e = spark.createDataFrame([(*x, None)[:4] for x in events], EVENTS)
    v = spark.createDataFrame([(n, w, ts(a), ts(b), g) for n, w, a, b, g in versions], VERSIONS)
    return rows(attributes_at_event(e, v, key="who", event_time="t", valid_from="vf", recorded_at="rec", version="no", deleted="gone", **kw).select("id", "no"))


def brute(events, versions):
    out = []
    for i, who, t, *u in events:
        known = u[0] if u else t
        if who is None or t is None or known is None:
            continue
        ok = [(a, b, n, bool(g)) for n, w, a, b, g in versions if w == who and a is not None and b is not None and a <= t and b <= known]
        if ok and not max(ok)[3]:
            out.append((i, max(ok)[2]))
    return sorted(out, key=repr)


def shuffled(seed):
    r = random.Random(seed)
    s = 1_000_000
    versions = [(i, r.choice(["a", "a", "a", "b", "c"]), r.randrange(200) * s, r.randrange(200) * s, r.random() < 0.2) for i in range(160)]
    versions += versions[:20]  # repeated rows
    versions += [(900, None, s, s, False), (901, "a", None, s, False), (902, "a", s, None, False), (903, "b", 3 * s, 3 * s, None)]
    points = [(i, r.choice(["a", "b", "c", "z", None]), r.randrange(-5, 210) * s, r.randrange(-5, 210) * s) for i in range(600)]
    return versions, points, [(998, "a", None, s), (999, None, s, s), (997, "a", s, None)]


@pytest.mark.parametrize("least", [1, 4, 4096])
def test_against_brute_force(spark, least):
    versions, points, odd = shuffled(least)
    same = [(i, w, t) for i, w, t, _ in points + odd]
    assert found(spark, same, versions, least=least) == brute(same, versions)
    assert found(spark, points + odd, versions, least=least, known_at="u") == brute(points + odd, versions)


def test_hot_key_recorded_all_at_once(spark):
    """A backfill makes hundreds of versions known at one moment."""
    s = 1_000_000
    versions = [(i, "hot", i * s, 500 * s, False) for i in range(1, 400)]
    events = [(i, "hot", t * s) for i, t in enumerate((0, 250, 499, 500, 501, 10_000))]
    assert found(spark, events, versions) == [(3, 399), (4, 399), (5, 399)]
    points = [(i, "hot", t * s, 600 * s) for i, t in enumerate((0, 1, 250, 399))]
    assert found(spark, points, versions, known_at="u") == [(1, 1), (2, 250), (3, 399)]


def test_cells_stay_small(spark):
    """Versions known in order, in reverse order and all for one valid time: no cell holds much more than 2 sqrt(n), nor more rectangles than twice its versions."""
    s, n = 1_000_000, 900
    versions = [(i, k, *at, False) for i in range(n) for k, at in {"up": (i * s, i * s + 5), "down": (i * s, (n - i) * s), "one": (s, i * s)}.items()]
    points = [(i, k, t * s, u * s) for i, (k, t, u) in enumerate((k, t, u) for k in ("up", "down", "one") for t in range(0, n, 90) for u in range(0, n, 90))]
    e = spark.createDataFrame(points, EVENTS)
    v = spark.createDataFrame([(i, w, ts(a), ts(b), g) for i, w, a, b, g in versions], VERSIONS)
    cells = cell_sizes(e, v, key="who", event_time="t", valid_from="vf", recorded_at="rec", version="no", deleted="gone", known_at="u").collect()
    assert len(cells) > 100 and max(c.versions for c in cells) <= 400 and all((c.rectangles or 0) <= 2 * c.versions for c in cells)
    assert found(spark, points, versions, known_at="u") == brute(points, versions)


def test_empty_tables(spark):
    assert found(spark, [], []) == []
    assert found(spark, [(1, "a", 5)], []) == []
    assert found(spark, [], [(1, "a", 1, 1, False)]) == []


def test_ties_take_the_greatest_number_and_left_keeps_all(spark):
    assert found(spark, [(1, "a", 9), (2, "q", 9)], [(1, "a", 1, 1, False), (2, "a", 1, 1, False)], how="left") == [(1, 2), (2, None)]


def test_clashing_extra_columns(spark):
    e = spark.createDataFrame([(1, "a", 9, 77, 5, 6)], "id long, who string, t long, no long, _key long, _cell long")
    v = spark.createDataFrame([(3, "a", ts(1), ts(1), False)], VERSIONS)
    out = attributes_at_event(e, v, key="who", event_time="t", valid_from="vf", recorded_at="rec", version="no", deleted="gone")
    assert out.columns == ["id", "who", "t", "no", "_key", "_cell", "no_found"]
    assert rows(out) == [(1, "a", 9, 77, 5, 6, 3)]
