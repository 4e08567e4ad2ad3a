import itertools
import json
import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import schemadrift
from tidemark.operators.schematree import assign, parse, script


def fields(**types):
    return json.dumps([{"name": n, "type": t, "nullable": True} for n, t in types.items()])


def edits(old, new, equal=()):
    cost, found = script(parse(old), parse(new), frozenset(equal))
    return cost, sorted((e.kind, e.path) for e in found)


def test_assignment_is_optimal():
    r = random.Random(3)
    for n in (1, 2, 3, 5):
        for _ in range(20):
            m = [[r.randrange(9) for _ in range(n)] for _ in range(n)]
            best = min(sum(m[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
            assert sum(m[i][j] for i, j in enumerate(assign(m))) == best


def test_flat_scripts():
    assert edits(fields(a="int32", b="string"), fields(b="string", a="int32")) == (0.0, [])
    assert edits(fields(a="int32"), fields(a="int64")) == (0.5, [("retyped", "a")])
    assert edits(fields(a="string"), fields(b="string")) == (2.0, [("added", "b"), ("removed", "a")])
    assert edits(fields(a="string", c="string"), fields(b="string", d="string"), [("a", "d")])[1] == [("added", "b"), ("removed", "c"), ("renamed", "d")]


def test_nested_scripts_find_moves():
    leaf = {"name": "zip", "type": "string"}
    old = json.dumps([{"name": "home", "type": {"type": "struct", "fields": [leaf]}}, {"name": "work", "type": {"type": "struct", "fields": []}}])
    new = json.dumps([{"name": "home", "type": {"type": "struct", "fields": []}}, {"name": "work", "type": {"type": "struct", "fields": [leaf]}}])
    assert edits(old, new) == (1.0, [("moved", "work.zip")])


def test_unreadable_schemas():
    assert parse("[") is None and parse(None) is None and parse("3") is None
    assert parse('{"fields": []}').children == ()


def run(spark, schemas, landed):
    s = spark.createDataFrame(schemas, "o long, v long, j string")
    d = spark.createDataFrame(landed, "o long, v long, p string, fields string, key string, record_key string")
    return schemadrift.full_drift(s, d, obj="o", version="v", schema="j", payload="p", key="record_key")


def line(o, v, **record):
    return (o, v, json.dumps(record), "clash", "clash", "clash")


SCHEMAS = [(1, 1, fields(record_key="string", a="string", b="int32")), (1, 4, fields(record_key="string", a2="string", c="int32")), (1, 4, fields(record_key="string", a2="string", c="int32")), (1, 2, "broken [")]
LANDED = [
    line(1, 1, record_key="x", a="p", b=1), line(1, 1, record_key="x", a="p", b=1), line(1, 1, record_key="y", a=None, b=2), line(1, 1, record_key="only1", a="zzz"),
    line(1, 4, record_key="x", a2="p", c=9), line(1, 4, record_key="y", c=2), (1, 4, '{"record_key": "z", "a2', None, None, None), (1, 4, None, None, None, None), (1, 4, "[1]", None, None, None), line(1, 4, a2="no key"),
]


def test_rename_by_equal_values(spark):
    pairs, read, found = run(spark, SCHEMAS, LANDED)
    assert rows(found.select("version", "change_type", "column_name")) == [(4, "added", "c"), (4, "removed", "b"), (4, "renamed", "a2")]


def test_unified_table(spark):
    pairs, read, found = run(spark, SCHEMAS, LANDED)
    plan = schemadrift.projections(pairs, found)
    out = schemadrift.unified(read, plan)
    got = rows(out.select("version", "record_key", F.col("fields")["a2"], F.col("fields")["b"]))
    assert got == [(1, "only1", "zzz", None), (1, "x", "p", "1"), (1, "y", None, "2"), (4, "x", "p", None), (4, "y", None, None)]
    typed = schemadrift.typed_table(spark, out, plan, 1)
    assert dict(typed.dtypes)["b"] == "int" and typed.count() == 5


def test_no_rename_without_common_records_or_with_one_difference(spark):
    s = [(1, 1, fields(record_key="string", a="string")), (1, 2, fields(record_key="string", b="string"))]
    assert rows(run(spark, s, [line(1, 1, record_key="x", a="p"), line(1, 2, record_key="q", b="p")])[2].select("change_type")) == [("added",), ("removed",)]
    differ = [line(1, 1, record_key="x", a="p"), line(1, 2, record_key="x", b="p"), line(1, 1, record_key="y", a="p"), line(1, 2, record_key="y")]
    assert rows(run(spark, s, differ)[2].select("change_type")) == [("added",), ("removed",)]


def test_nulls_alone_are_no_evidence(spark):
    s = [(1, 1, fields(record_key="string", a="string")), (1, 2, fields(record_key="string", b="string"))]
    d = [line(1, 1, record_key="x", a=None), line(1, 2, record_key="x")]
    assert rows(run(spark, s, d)[2].select("change_type")) == [("added",), ("removed",)]


def test_least_cost_over_all_pairs():
    swap = edits(fields(a="int32", b="string"), fields(a="string", b="int32"), [("a", "b"), ("b", "a")])
    assert swap == (0.8, [("renamed", "a"), ("renamed", "b")])
    assert edits(fields(a="int32", b="string"), fields(a="string", b="int32")) == (1.0, [("retyped", "a"), ("retyped", "b")])
    assert edits(fields(a="int32"), fields(b="int64"), [("a", "b")]) == (0.9, [("renamed", "b")])


def test_costs_against_all_matchings():
    """The script's cost is the least over every way to match the fields of two flat schemas."""
    r = random.Random(11)
    for _ in range(60):
        old, new = ({n: r.choice(["s", "i"]) for n in r.sample("abcd", r.randrange(5))} for _ in range(2))
        equal = {(a, b) for a in old for b in new if r.random() < 0.4}
        price = lambda a, b: 1e9 if a != b and (a, b) not in equal else (a != b) * 0.4 + (old[a] != new[b]) * 0.5  # noqa: B023, E731
        best, size = 1e9, min(len(old), len(new))
        for k in range(size + 1):
            for xs in itertools.combinations(old, k):
                for ys in itertools.permutations(new, k):
                    best = min(best, sum(map(price, xs, ys)) + len(old) + len(new) - 2 * k)
        assert abs(edits(fields(**old), fields(**new), equal)[0] - best) < 1e-9


def nested(**inner):
    return json.dumps([{"name": "record_key", "type": "string"}, {"name": "home", "type": {"type": "struct", "fields": [{"name": n, "type": t} for n, t in inner.items()]}}])


def test_nested_renames_reach_the_projections(spark):
    s = [(1, 1, nested(zip="string", old="int32")), (1, 2, nested(postcode="string", floor="int32"))]
    d = [line(1, 1, record_key="x", home={"zip": "07", "old": 3}), line(1, 2, record_key="x", home={"postcode": "07", "floor": 9}), line(1, 1, record_key="y", home={"zip": None}), line(1, 2, record_key="y", home=None)]
    pairs, read, found = run(spark, s, d)
    assert rows(found.select("change_type", "column_name")) == [("added", "home.floor"), ("removed", "home.old"), ("renamed", "home.postcode")]
    out = schemadrift.unified(read, schemadrift.projections(pairs, found))
    got = rows(out.select("version", "record_key", F.col("fields")["home.postcode"], F.col("fields")["home.old"], F.col("fields")["home.floor"]))
    assert got == [(1, "x", "07", "3", None), (1, "y", None, None, None), (2, "x", "07", None, "9"), (2, "y", None, None, None)]


def test_moves_reach_the_projections(spark):
    struct = lambda name, *inner: {"name": name, "type": {"type": "struct", "fields": [{"name": n, "type": "string"} for n in inner]}}
    key = {"name": "record_key", "type": "string"}
    s = [(1, 1, json.dumps([key, struct("home", "zip", "city"), struct("work", "street")])), (1, 2, json.dumps([key, struct("home", "city"), struct("work", "street", "zip")]))]
    d = [line(1, 1, record_key="x", home={"zip": "07", "city": "c"}, work={"street": "s"}), line(1, 2, record_key="x", home={"city": "c"}, work={"street": "s", "zip": "08"})]
    pairs, read, found = run(spark, s, d)
    assert rows(found.select("change_type", "column_name")) == [("moved", "work.zip")]
    out = schemadrift.unified(read, schemadrift.projections(pairs, found))
    assert rows(out.select("version", F.col("fields")["work.zip"])) == [(1, "07"), (2, "08")]


def test_reused_name_is_kept_apart(spark):
    s = [(1, 1, fields(record_key="string", a="string", c="string")), (1, 2, fields(record_key="string", c="string", a="string", d="int32")), (1, 3, fields(record_key="string", c2="string", a="string"))]
    d = [line(1, 1, record_key="x", a="p", c="q"), line(1, 2, record_key="x", a="p", c="q", d=1), line(1, 3, record_key="x", a="p", c2="q")]
    pairs, read, found = run(spark, s, d)
    out = schemadrift.unified(read, schemadrift.projections(pairs, found))
    assert {r.fields["c2"] for r in out.collect()} == {"q"}


def test_empty(spark):
    pairs, read, found = run(spark, [], [])
    assert rows(found) == [] and rows(schemadrift.unified(read, schemadrift.projections(pairs, found))) == []
