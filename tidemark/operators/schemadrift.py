"""Schemas that drift between files: every change between versions, and one consistent table over all of them.

Versions of an object are compared pairwise, each with the next lower one, by the least-cost edit script between their schema trees
(``schematree``). A field that is gone and one that is new (both below parents that stayed) are a rename if both hold equal values in all records readably delivered with both versions, of which there
must be one at least, with a value that isn't null; values are compared through two independent additive hashes per field, so the records are never paired with each other. The scripts are
compiled into one projection per version, and the projections turn every record into the fields of the newest schema. Fields of structs are fields of their own, under dotted paths: they are renamed, moved and
projected like top-level ones.

Defined cases: a schema that can't be read is left out of its object's versions; a version delivered twice counts once; a record that isn't a JSON object or
lacks the key is unreadable; fields left out equal null; repeated records appear once; a removed field stays a column; a removed field whose name was later
given to another field is kept as ``name__vN``, N being its last version; an object with one version has no change; empty tables give empty results.

Scale: records are shuffled by object, version pair and key, so a hot object spreads; only versions with both gone and new fields are read for evidence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.schematree import leaves, parse, renamings, script
from tidemark.runtime import materialise

SCRIPT = "object long, prev long, version long, change_type string, column_name string, old_name string, old_type string, new_type string, distance double"


def version_pairs(schemas: DataFrame, *, obj: str, version: str, schema: str, at: str | None = None) -> DataFrame:
    """(object, prev, version, old_json, new_json) of each readable version and the next lower one; null for an object's first."""
    order = F.struct(F.col(at) if at else F.lit(0), F.col(schema))
    one = schemas.filter(F.col(schema).isNotNull()).groupBy(F.col(obj).alias("object"), F.col(version).alias("version")).agg(F.max_by(schema, order).alias("new_json"))
    # as parse() reads it: a list, or an object with a list of fields
    ok = one.filter(F.expr("try_parse_json(new_json) is not null and is_variant_null(try_parse_json(new_json)) = false")).mapInPandas(_readable, one.schema)
    w = Window.partitionBy("object").orderBy("version")
    return ok.withColumns({"prev": F.lag("version").over(w), "old_json": F.lag("new_json").over(w)})


def _readable(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f[[parse(x) is not None for x in f["new_json"]]]


def records(landed: DataFrame, *, obj: str, version: str, payload: str, key: str) -> DataFrame:
    """Readable records: object, version, record_key, fields (map of text) and the columns of ``landed`` but the payload."""
    m = F.from_json(F.col(payload), "map<string,string>")
    rest = [c for c in landed.columns if c not in (obj, version, payload)]
    found = landed.select(F.col(obj).alias("object"), F.col(version).alias("version"), *(F.col(f"`{c}`").alias(f"_in_{c}") for c in rest), F.when(F.try_parse_json(F.col(payload)).isNotNull(), m).alias("fields"))
    return found.withColumn("record_key", F.col("fields").getItem(key)).filter("record_key is not null")


def _candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for x in f.itertuples():
            gone, fresh = renamings(parse(x.old_json), parse(x.new_json))
            if gone and fresh:
                rows += [(x.object, x.prev, x.version, False, gone), (x.object, x.version, x.version, True, fresh)]
        yield pd.DataFrame(rows, columns=["object", "version", "pair", "is_new", "wanted"])


def value_at(fields: Column, path: Column) -> Column:
    """The text at a path of a record's fields: a field of that very name, or one within a struct, whose text is JSON."""
    top = F.substring_index(path, ".", 1)
    rest = F.replace(F.substr(path, F.length(top) + 2), F.lit("."), F.lit("']['"))
    nested = F.call_function("get_json_object", fields[top], F.concat(F.lit("$['"), rest, F.lit("']")))
    return F.when(F.map_contains_key(fields, path) | ~F.contains(path, F.lit(".")), fields[path]).otherwise(nested)


def rename_evidence(pairs: DataFrame, read: DataFrame) -> DataFrame:
    """(object, version, old_fields, new_fields): for each pair, its gone and its new fields with the digest of their values over the common keys."""
    sides = pairs.filter("prev is not null").mapInPandas(_candidates, "object long, version long, pair long, is_new boolean, wanted array<string>")
    picked = read.join(sides, ["object", "version"]).select("object", "pair", "record_key", "is_new", F.struct("wanted", F.transform("wanted", lambda n: value_at(F.col("fields"), n)).alias("held")).alias("x"))
    both = picked.groupBy("object", "pair", "record_key").agg(F.max(F.when(~F.col("is_new"), F.col("x"))).alias("a"), F.max(F.when(F.col("is_new"), F.col("x"))).alias("b")).filter("a is not null and b is not null")
    side = lambda c, new: F.transform(F.arrays_zip(f"{c}.wanted", f"{c}.held"), lambda z: F.struct(F.lit(new).alias("is_new"), z["wanted"].alias("name"), z["held"].alias("value")))
    long = both.select("object", "pair", "record_key", F.explode(F.concat(side("a", False), side("b", True))).alias("f")).select("object", "pair", "record_key", "f.*")
    h = lambda seed: F.when(F.col("value").isNotNull(), F.xxhash64(F.lit(seed), "record_key", "value")).otherwise(F.lit(0).cast("bigint"))
    digests = long.groupBy("object", "pair", "is_new", "name").agg(F.sum(h(1).cast("decimal(38,0)")).cast("string").alias("s"), F.bit_xor(h(2)).alias("x"), F.count("value").alias("k")).filter("k > 0")
    one = F.struct("name", F.concat_ws("/", "s", F.col("x").cast("string")).alias("digest"))
    return digests.groupBy("object", F.col("pair").alias("version")).agg(
        F.collect_list(F.when(~F.col("is_new"), one)).alias("old_fields"), F.collect_list(F.when(F.col("is_new"), one)).alias("new_fields")
    )


def _scripts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for x in f.itertuples():
            old = {} if x.old_fields is None else {y["name"]: y["digest"] for y in x.old_fields}
            new = {} if x.new_fields is None else {y["name"]: y["digest"] for y in x.new_fields}
            equal = frozenset((a, b) for b, d in new.items() for a, e in old.items() if d == e)
            cost, edits = script(parse(x.old_json), parse(x.new_json), equal)
            rows += [(x.object, x.prev, x.version, e.kind, e.path, e.old_path, e.old_type, e.new_type, cost) for e in edits]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCRIPT.split(", ")])


def drift(pairs: DataFrame, read: DataFrame) -> DataFrame:
    """Every edit between consecutive versions: change_type added, removed, renamed, retyped or moved, with names and types before and after."""
    return pairs.filter("prev is not null").join(rename_evidence(pairs, read), ["object", "version"], "left").mapInPandas(_scripts, SCRIPT)


def _follow(path: str, moves: dict[str, str]) -> str:
    """Where a path goes: by the edit of its nearest renamed or moved parent, or of itself."""
    for end in range(len(path), 0, -1):
        if (end == len(path) or path[end] == ".") and path[:end] in moves:
            return moves[path[:end]] + path[end:]
    return path


def _compile(group: pd.DataFrame) -> pd.DataFrame:
    """Projections of one object: a row per version and path with the column it ends in. Versions of one object are few; records aren't touched."""
    out = []
    steps = []
    for x in group.sort_values("version").itertuples():
        edits = x.edits if x.edits is not None else []
        moves = {e["old_name"]: e["column_name"] for e in edits if e["change_type"] in ("renamed", "moved")}
        steps.append((x.version, leaves(parse(x.new_json)), moves))
    types: dict[str, str] = {}
    target: dict[tuple[int, str], str] = {}
    for i in range(len(steps) - 1, -1, -1):
        version, fields, _ = steps[i]
        follow, taken = {}, set()
        if i + 1 < len(steps):
            nxt_version, nxt_fields, moves = steps[i + 1]
            reused = set(moves.values())  # a name that another field took over isn't its old owner's any more
            follow = {n: to for n in fields if (to := _follow(n, moves)) in nxt_fields and (to != n or n not in reused)}
            taken = {target[nxt_version, m] for m in follow.values()}
        for name, kind in fields.items():
            if name in follow:
                target[version, name] = target[nxt_version, follow[name]]
            else:
                live = name in types and (i + 1 == len(steps) or name in taken or name in {target[nxt_version, m] for m in nxt_fields})
                target[version, name] = f"{name}__v{version}" if live else name
            types.setdefault(target[version, name], kind)
            out.append((group["object"].iloc[0], version, name, target[version, name], types[target[version, name]]))
    return pd.DataFrame(out, columns=["object", "version", "field", "column_name", "column_type"])


def projections(pairs: DataFrame, edits: DataFrame) -> DataFrame:
    """(object, version, field, column_name, column_type): where each path of each version ends, and the newest type of that column."""
    script = edits.groupBy("object", "version").agg(F.collect_list(F.struct("change_type", "column_name", "old_name")).alias("edits"))
    return pairs.select("object", "version", "new_json").join(script, ["object", "version"], "left").groupBy("object").applyInPandas(_compile, "object long, version long, field string, column_name string, column_type string")


def unified(read: DataFrame, plan: DataFrame) -> DataFrame:
    """Every readable record once, its values under their final names: (object, version, record_key, fields, _in_...)."""
    names = plan.groupBy("object", "version").agg(F.sort_array(F.collect_list(F.struct("field", "column_name"))).alias("names"))
    placed = F.transform("names", lambda n: F.struct(n["column_name"].alias("key"), value_at(F.col("fields"), n["field"]).alias("value")))
    finals, known = F.transform("names", lambda n: n["column_name"]), F.transform("names", lambda n: F.substring_index(n["field"], ".", 1))
    # a field that its schema doesn't name keeps its name, unless that is another field's final one
    known = F.array_union(known, F.transform("names", lambda n: n["field"]))
    own = lambda k: F.when(F.array_contains(finals, k), F.concat(k, F.lit("__raw"))).otherwise(k)
    others = F.transform(F.filter(F.map_entries("fields"), lambda e: F.col("names").isNull() | ~F.array_contains(known, e["key"])), lambda e: F.struct(F.when(F.col("names").isNull(), e["key"]).otherwise(own(e["key"])).alias("key"), e["value"].alias("value")))
    entries = F.concat(F.coalesce(placed, F.array().cast("array<struct<key:string,value:string>>")), others)
    rest = [c for c in read.columns if c.startswith("_in_")]
    sorted_entries = F.array_sort(F.filter(entries, lambda e: e["value"].isNotNull()))
    moved = read.join(names, ["object", "version"], "left").select("object", "version", "record_key", sorted_entries.alias("e"), *rest)
    once = moved.groupBy("object", "version", "record_key", "e").agg(*(F.min(c).alias(c) for c in rest))
    return once.withColumn("fields", F.map_from_entries("e")).drop("e")


#: Spark's name for each type name a schema may use; fixed values.
TYPES = {"string": "string", "large_string": "string", "double": "double", "float": "float", "int32": "int", "int64": "bigint", "int16": "smallint", "int8": "tinyint", "bool": "boolean", "timestamp[us]": "timestamp", "date32": "date"}


def typed_table(spark: SparkSession, table: DataFrame, plan: DataFrame, obj: int) -> DataFrame:
    """One object's table with a typed column for each field; values that don't fit the newest type become null."""
    wanted = plan.filter(F.col("object") == obj).groupBy("column_name").agg(F.first("column_type").alias("t")).orderBy("column_name").collect()
    cols = [F.col("fields").getItem(r.column_name).try_cast(TYPES.get(r.t, "string")).alias(re.sub(r"[ ,;{}()\n\t=]", "_", r.column_name)) for r in wanted]
    return table.filter(F.col("object") == obj).select("version", *cols)


def full_drift(schemas: DataFrame, landed: DataFrame, *, obj: str, version: str, schema: str, payload: str, key: str, captured_at: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, records, edits); the small tables of pairs and edits are cut from their lineage, as several steps use them."""
    pairs = materialise(version_pairs(schemas, obj=obj, version=version, schema=schema, at=captured_at), "drift-pairs")
    read = records(landed, obj=obj, version=version, payload=payload, key=key)
    return pairs, read, materialise(drift(pairs, read), "drift-edits")
