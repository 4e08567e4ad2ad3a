"""Full history of changing records from periodic snapshots, kept by Merkle comparison.

The keys of an object are hashed into 64**depth leaves; the depth is chosen when the object first appears, so that a leaf holds about ten keys (few, since one changed key makes its whole leaf differ), and kept. Each snapshot has, for every leaf, a digest of its records, and
for every node above, a digest of its children, up to the root. A snapshot is compared with the one before it from the root: only below differing nodes are children compared, and only the records
of leaves that differ are set against each other to give new versions.

Between runs ``MerkleHistory`` keeps the tree of each object's last snapshot and the versions themselves: open ones in files by range of leaves, closed ones in files that are only ever added. A new
snapshot is compared with the stored tree; of the versions only the files with differing leaves are read and written anew, and what it closes is appended. One manifest publishes all of it. A run may bring any number of
snapshots of any objects, which are compared with each other in the same pass.

Where absence means nothing (incremental delivery) a leaf delivered as the time before repeats what was last
delivered of its keys, and keys are compared with their own last delivered record.

Defined cases: as for ``snapdiff``: snapshots follow taken_at, the newest row of a key in a snapshot counts, nulls differ from empty
values, repeated rows don't matter, the first snapshot opens a version for each key, a removal opens a deleted version, which has the attributes of the version it ends, and a key that comes back closes it. A snapshot whose number is known is
left out, so that a run can be repeated; one that is new but older than the last of its object is refused; no new snapshot commits nothing.

Scale: rows are folded to one per key and snapshot map-side; digests are sums and xors of hashes, so they are partial aggregates; digest tables have one row
per snapshot and leaf; the records of a leaf are never collected, only a key's own deliveries meet in a window. The driver sees one row per object and the numbers of the files' leaf ranges that are touched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.snapdiff import key_hashes, ordered_snapshots, row_hash
from tidemark.runtime import materialise, new_path
from tidemark.storage.keyed import PER_BUCKET
from tidemark.storage.table import CommitConflict, VersionedTable, nullable

BITS = 6
PER_LEAF = 8
DEEPEST = 10
STATE = "merkle"


def depth_for(keys: int, per_leaf: int) -> int:
    """Levels below the root so that a leaf has about ``per_leaf`` keys, at most eight times as many."""
    return max(1, min(DEEPEST, math.floor(math.log(max(keys / per_leaf, 1), 2**BITS) + 0.5)))


def _by_object(objects: dict[str, dict], field: str) -> Column:
    return F.create_map(*(x for o, s in objects.items() for x in (F.lit(o), F.lit(s[field]))))[F.col("object").cast("string")]


def node_at(h: Column, level: Column) -> Column:
    """The number of a key's node at a level: the first bits of its hash; 0 at the root."""
    return F.when(level == 0, F.lit(0).cast("bigint")).otherwise(F.call_function("shiftrightunsigned", h, (64 - BITS * level).cast("int")))


def newest_rows(rows: DataFrame, numbered: DataFrame, objects: DataFrame, depths: Column, *, obj: str, number: str, key: str, updated_at: str, compared: list[Column], carried: list[str]) -> DataFrame:
    """(object, rank, _key, h, node, row, incremental, carried...): one row per key and snapshot."""
    value = F.struct(F.col(updated_at).cast("bigint").alias("upd"), row_hash(compared).alias("row"), *carried)
    newest = rows.select(F.col(obj), F.col(number), F.col(key).alias("_key"), value.alias("x")).join(numbered.select(obj, number, "rank"), [obj, number]).groupBy(obj, "rank", "_key").agg(F.max("x").alias("x"))
    out = newest.join(objects, obj, "left").select(
        F.col(obj).alias("object"), "rank", "_key", key_hashes(F.col("_key"))[0].alias("h"), F.col("x.row").alias("row"), F.coalesce("incremental", F.lit(False)).alias("incremental"), *(F.col(f"x.{c}").alias(c) for c in carried)
    )
    return out.withColumn("node", node_at(F.col("h"), depths))


def trees(newest: DataFrame, depths: Column) -> DataFrame:
    """(object, rank, level, node, digest) of all nodes of all new snapshots: every leaf counts in each node above it, so one aggregate gives all levels."""
    mixed = F.xxhash64("h", "row")
    fold = lambda h: [F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 24)).alias("s"), F.count("*").alias("n")]
    leaves = newest.groupBy("object", "rank", "node").agg(*fold(mixed))
    up = leaves.select("object", "rank", F.col("node").alias("_leaf"), F.xxhash64("node", "x", "s", "n").alias("h"), F.explode(F.sequence(F.lit(0), depths.cast("int"))).alias("level"))
    node = F.call_function("shiftrightunsigned", F.col("_leaf"), (BITS * (depths - F.col("level"))).cast("int"))
    tree = up.groupBy("object", "rank", "level", node.alias("node")).agg(*fold(F.col("h")))
    return tree.select("object", "rank", "level", "node", F.xxhash64("x", "s", "n").alias("digest"))


def changed_leaves(tree: DataFrame, stored: DataFrame | None, lasts: Column, depths: Column, used: set[int]) -> DataFrame:
    """(object, rank, node): the leaves of each new snapshot that differ from the snapshot before. ``stored``: the tree of each object's last snapshot; ``lasts``: the rank of its last new one; ``used``: the depths in use."""
    leaves, differing = [], None
    for level in range(max(used) + 1):
        here = tree.filter(F.col("level") == level)
        before = here if stored is None else here.unionByName(stored.filter(F.col("level") == level))
        after = before.filter(F.col("rank") < lasts).select("object", (F.col("rank") + 1).alias("rank"), "node", "digest", F.lit(False).alias("now"))
        sides = here.select("object", "rank", "node", "digest", F.lit(True).alias("now")).unionByName(after)
        if differing is not None:
            # only children of nodes that differ are looked at
            above = differing.select("object", "rank", F.col("node").alias("_parent"))
            sides = sides.withColumn("_parent", F.call_function("shiftrightunsigned", F.col("node"), F.lit(BITS))).join(above, ["object", "rank", "_parent"], "left_semi")
        pair = sides.groupBy("object", "rank", "node").agg(F.max(F.when(F.col("now"), F.col("digest"))).alias("a"), F.max(F.when(~F.col("now"), F.col("digest"))).alias("b"))
        differing = pair.filter("not (a <=> b)").select("object", "rank", "node")
        if level in used:
            leaves.append(differing.filter(depths == level) if len(used) > 1 else differing)
    out = leaves[0]
    for part in leaves[1:]:
        out = out.unionByName(part)
    return out


class MerkleHistory:
    """The history of some objects' keys, built from their snapshots as they come."""

    def __init__(self, spark: SparkSession, root: str, *, obj: str, number: str, taken_at: str, key: str, updated_at: str, compared: list[Column], carried: list[str] | None = None, per_leaf: int = PER_LEAF, per_file: int = PER_BUCKET):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions, self.tree, self.snapshots = (VersionedTable(spark, f"{self.root}/{n}") for n in ("versions", "tree", "snapshots"))
        self.names = {"obj": obj, "number": number, "key": key, "updated_at": updated_at, "compared": compared, "carried": carried or []}
        self.taken_at, self.per_leaf, self.per_file = taken_at, per_leaf, per_file

    def _known(self, m) -> DataFrame | None:
        return self.snapshots.read(m.properties[STATE]["snapshots"]) if m else None

    def _numbered(self, rows: DataFrame, m) -> DataFrame:
        """(obj, number, taken, rank) of the snapshots that are new."""
        obj, number = self.names["obj"], self.names["number"]
        found = ordered_snapshots(rows, obj, number, self.taken_at).drop("last")
        if m is None:
            return materialise(found, "merkle-snapshots")
        known = self._known(m)
        last = known.groupBy(obj).agg(F.max("rank").alias("_last"), F.max("taken").alias("_until"))
        new = found.join(known.select(obj, number), [obj, number], "left_anti").join(last, obj, "left")
        order = Window.partitionBy(obj).orderBy("taken", number)
        out = materialise(new.withColumn("rank", F.coalesce("_last", F.lit(0)) + F.row_number().over(order)), "merkle-snapshots")
        if not out.filter("taken < _until").isEmpty():
            raise ValueError("a snapshot is older than the last one of its object")
        return out.select(obj, number, "taken", "rank")

    def _objects(self, rows: DataFrame, numbered: DataFrame, known: dict[str, dict]) -> dict[str, dict]:
        """What is kept of each object: its depth, the ranges of leaves its files are cut by (first number and how many), and the rank of its last snapshot."""
        obj = self.names["obj"]
        lasts = {r[obj]: r["last"] for r in numbered.filter(F.col(obj).isNotNull()).groupBy(obj).agg(F.max("rank").alias("last")).collect()}
        unknown = [o for o in lasts if str(o) not in known]
        # only objects that are new need their keys counted
        keys = {r[obj]: r["keys"] for r in rows.filter(F.col(obj).isin(unknown)).groupBy(obj).agg(F.approx_count_distinct(self.names["key"]).alias("keys")).collect()} if unknown else {}
        out, top = {o: dict(s) for o, s in known.items()}, max((s["first"] + s["files"] for s in known.values()), default=0)
        for o in sorted(lasts, key=str):
            own = out.setdefault(str(o), {})
            if "depth" not in own:
                own |= {"depth": depth_for(keys[o], self.per_leaf), "first": top, "files": max(1, -(-keys[o] // self.per_file))}
                top += own["files"]
            own["last"] = lasts[o]
        return out

    @staticmethod
    def file_range(objects: dict[str, dict], node: Column) -> Column:
        """Which range of its object's leaves a leaf belongs to: a file's leaves are neighbours, and no leaf lies in two files."""
        shift = lambda c, by: F.call_function("shiftrightunsigned", c, by.cast("int"))
        bits = BITS * _by_object(objects, "depth")
        top = shift(node, F.greatest(bits - 30, F.lit(0)))
        return (_by_object(objects, "first") + shift(top * _by_object(objects, "files"), F.least(bits, F.lit(30)))).cast("int")

    def add(self, rows: DataFrame, objects: DataFrame) -> dict:
        """Adds the snapshots in ``rows`` as one commit. ``objects``: obj and ``incremental``. Returns how much was new, differed and was read."""
        base = self.versions.version()
        m = self.versions.manifest(base) if base >= 0 else None
        numbered = self._numbered(rows, m)
        state = m.properties[STATE] if m else {"objects": {}}
        kept_objects = self._objects(rows, numbered, state["objects"])
        fresh = {o for o, s in kept_objects.items() if s != state["objects"].get(o)}
        if not fresh:
            return {"version": base, "leaves": 0, "changed": 0, "read": 0}
        depths, lasts = _by_object(kept_objects, "depth"), _by_object(kept_objects, "last")
        newest = materialise(newest_rows(rows, numbered, objects, depths, **self.names), "merkle-rows")
        tree = materialise(trees(newest, depths), "merkle-tree", partition="level")
        stored = self.tree.read(state["tree"]) if m else None
        place = F.row_number().over(Window.partitionBy("object", "node").orderBy("rank"))
        changed = materialise(changed_leaves(tree, stored, lasts, depths, {s["depth"] for s in kept_objects.values()}).withColumn("place", place), "merkle-changed")
        all_versions, own = self._versions(newest, changed, m, kept_objects)
        # the trees of the last snapshots take the place of those before
        trunk = tree.filter(F.col("rank") == lasts)
        if stored is not None:
            trunk = trunk.unionByName(stored.filter(~F.col("object").cast("string").isin(list(fresh))))
        leaves = tree.filter(F.col("level") == depths)
        return self._publish(base, m, all_versions, own, trunk, leaves, changed, numbered, kept_objects)

    def _versions(self, newest: DataFrame, changed: DataFrame, m, kept_objects: dict) -> tuple[DataFrame, list]:
        """All versions of the files whose leaves differ: closed ones have ``to_rank``. And these files."""
        carried, columns = self.names["carried"], ["object", "_key", "h", "row", "incremental", *self.names["carried"]]
        depths, stored, own = _by_object(kept_objects, "depth"), None, []
        if m:
            touched = {r[0] for r in changed.select(self.file_range(kept_objects, F.col("node")).alias("f")).distinct().collect()}
            own = [f for f in m.files if f.bucket in touched]
            stored = self.versions._frame(m.struct, [f.path for f in own])
        met = newest.join(changed.select("object", "rank", "node", "place"), ["object", "rank", "node"]).select(*columns, "node", "rank", "place", F.lit(False).alias("_prior"))
        if stored is not None:
            # what is open of the differing leaves, as their state before the first change
            prior = stored.filter("to_rank is null").withColumn("node", node_at(F.col("h"), depths)).join(changed.select("object", "node").distinct(), ["object", "node"], "left_semi")
            met = met.unionByName(prior.select(*(F.when(~F.col("is_deleted"), F.col(c)).alias(c) if c == "row" else F.col(c) for c in columns), "node", F.col("from_rank").alias("rank"), F.lit(0).alias("place"), F.lit(True).alias("_prior")))
        by_key = Window.partitionBy("object", "_key").orderBy("place")
        seen = met.withColumns({"_row0": F.lag("row").over(by_key), "_place0": F.lag("place").over(by_key), "_place1": F.lead("place").over(by_key)})
        # a full delivery in which a key is missing: the leaf's next changed one after the key's, unless the key is in it
        after = changed.select("object", "node", (F.col("place") - 1).alias("place"), F.col("rank").alias("_gone"))
        seen = seen.join(after, ["object", "node", "place"], "left")
        back = ~F.col("incremental") & (F.col("_place0") < F.col("place") - 1)
        opens = ~F.col("_prior") & (F.col("_row0").isNull() | back | (F.col("_row0") != F.col("row")))
        gone = F.col("row").isNotNull() & ~F.col("incremental") & F.col("_gone").isNotNull() & ((F.col("_place1") > F.col("place") + 1) | F.col("_place1").isNull())
        version = lambda r, d: F.struct(F.col(r).alias("from_rank"), F.lit(d).alias("is_deleted"))
        new = seen.select(*columns, F.explode(F.array_compact(F.array(F.when(opens, version("rank", False)), F.when(gone, version("_gone", True))))).alias("e")).select(*columns, "e.*")
        every = new.withColumn("_new", F.lit(True))
        if stored is not None:
            every = every.unionByName(stored.filter("to_rank is null").select(*columns, "from_rank", "is_deleted", F.lit(False).alias("_new")))
        w = Window.partitionBy("object", "_key").orderBy("from_rank")
        # a deleted version has the attributes of the version it ends
        kept = {c: F.when(F.col("_new") & F.col("is_deleted"), F.lag(c).over(w)).otherwise(F.col(c)) for c in carried}
        return every.withColumns({**kept, "to_rank": F.lead("from_rank").over(w)}).drop("_new"), own

    def _publish(self, base: int, m, all_versions: DataFrame, own: list, trunk: DataFrame, leaves: DataFrame, changed: DataFrame, numbered: DataFrame, kept_objects: dict) -> dict:
        tasks = max(1, min(sum(s["files"] for s in kept_objects.values()), 4 * self.spark.sparkContext.defaultParallelism))
        # closed versions belong to no range and are spread as they come
        open_in = F.when(F.col("to_rank").isNull(), self.file_range(kept_objects, node_at(F.col("h"), _by_object(kept_objects, "depth"))))
        placed = all_versions.withColumn("__file", open_in).repartition(tasks, "__file", F.when(F.col("__file").isNull(), F.pmod("h", F.lit(tasks)))).sortWithinPartitions("__file", "h")
        files = self.versions.stage(placed, "__file")
        properties = {STATE: {"objects": kept_objects, "tree": self._replace(self.tree, trunk), "snapshots": self._replace(self.snapshots, numbered if m is None else self._known(m).unionByName(numbered))}}
        kept = [f for f in m.files if f not in own] if m else []
        figures = {"leaves": leaves.count(), "changed": changed.count(), "read_bytes": sum(f.bytes for f in own), "kept_bytes": sum(f.bytes for f in kept)}
        version = self.versions.commit(base, "snapshots", nullable(all_versions.schema), [*kept, *files], figures, properties)
        return {"version": version, "leaves": figures["leaves"], "changed": figures["changed"], "read": figures["read_bytes"]}

    @staticmethod
    def _replace(table: VersionedTable, df: DataFrame, retries: int = 5) -> int:
        """A new version of a side table. It counts only once a manifest of the versions names it, so one that a dead run left behind does no harm."""
        files = table.stage(df)
        for attempt in range(retries + 1):
            try:
                return table.commit(table.version(), "replace", nullable(df.schema), files, {}, {})
            except CommitConflict:
                if attempt == retries:
                    raise
        raise AssertionError

    def read(self) -> DataFrame:
        """One row per version: obj, key, from_snapshot, to_snapshot (0 while open), valid_from, valid_to, is_current, is_deleted and the carried columns."""
        obj, number, key = (self.names[n] for n in ("obj", "number", "key"))
        m = self.versions.manifest()
        at = self._known(m).select(F.col(obj).alias("object"), "rank", F.col(number).alias("_no"), F.col("taken").alias("_taken"))
        begin = at.select("object", F.col("rank").alias("from_rank"), "_no", "_taken")
        end = at.select("object", F.col("rank").alias("to_rank"), F.col("_no").alias("_no1"), F.col("_taken").alias("_taken1"))
        return self.versions.read(m.version).join(begin, ["object", "from_rank"]).join(end, ["object", "to_rank"], "left").select(
            F.col("object").alias(obj), F.col("_key").alias(key), F.col("_no").alias("from_snapshot"), F.coalesce("_no1", F.lit(0)).alias("to_snapshot"),
            F.col("_taken").alias("valid_from"), F.col("_taken1").alias("valid_to"), F.col("to_rank").isNull().alias("is_current"), "is_deleted", *self.names["carried"],
        )


def history(rows: DataFrame, objects: DataFrame, *, per_leaf: int = PER_LEAF, **names) -> DataFrame:
    """The history of all snapshots of a table at once, with the columns of ``MerkleHistory.read``."""
    out = MerkleHistory(rows.sparkSession, new_path(rows.sparkSession, "history"), per_leaf=per_leaf, **names)
    out.add(rows, objects)
    if not out.versions.exists():
        carried = [rows.schema[c] for c in names.get("carried") or []]
        kinds = {"from_snapshot": rows.schema[names["number"]].dataType, "to_snapshot": rows.schema[names["number"]].dataType, "valid_from": rows.schema[names["taken_at"]].dataType, "valid_to": rows.schema[names["taken_at"]].dataType, "is_current": T.BooleanType(), "is_deleted": T.BooleanType()}
        return rows.sparkSession.createDataFrame([], T.StructType([rows.schema[names["obj"]], rows.schema[names["key"]], *(T.StructField(n, k) for n, k in kinds.items()), *carried]))
    return out.read()
