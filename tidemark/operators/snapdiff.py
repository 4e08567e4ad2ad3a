"""What changed between consecutive full snapshots.

Each snapshot row becomes a compact entry: 128 bits of key hash, the snapshot's rank within its object, the update time and a row hash. The entries
are hash-bucketed by key; a bucket is sorted in numpy and the key arrays of consecutive snapshots are set against each other with searchsorted.
Only keys that differ come out, and only for these are the full rows fetched again.

Defined cases: snapshots of an object are ordered by taken_at, then by number; the first gives no change; of several rows of a key in one
snapshot the one with the latest update time counts (null is earliest, ties go to the greatest row hash); null and empty values differ; a null key
is a key like any other; repeated rows don't matter; an unknown strategy counts as full; empty tables give an empty result.

Scale: one shuffle of about 44 bytes a row, by hash bucket: a hot object spreads over all buckets, and copies of one hot key are folded map-side
before it. A bucket is held in memory as arrays; their number follows the input, so that a bucket stays at about ``per_bucket`` entries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import marked

CHANGE = "object long, rank int, h1 long, h2 long, change int, source_rank int"
CHANGE_TYPES = {"object": "int64", "rank": "int32", "h1": "int64", "h2": "int64", "change": "int32", "source_rank": "int32"}
ADDED, REMOVED, CHANGED = 1, 2, 3
NAMES = {ADDED: "added", REMOVED: "removed", CHANGED: "changed"}


def ordered_snapshots(rows: DataFrame, obj: str, number: str, taken_at: str) -> DataFrame:
    """(obj, number, taken, rank, last) of each snapshot, ``last`` being the object's number of snapshots: as many rows as deliveries, found by a map-side aggregate."""
    firsts = rows.groupBy(obj, number).agg(F.min(taken_at).alias("_taken"))
    w = Window.partitionBy(obj)
    return firsts.select(obj, number, F.col("_taken").alias("taken"), F.row_number().over(w.orderBy("_taken", number)).alias("rank"), F.count("*").over(w).alias("last"))


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key, key.isNull()).alias("h1"), F.xxhash64(F.lit(1), key.isNull(), key).alias("h2")]


def row_hash(compared: list[Column]) -> Column:
    return F.xxhash64(*marked(*compared))


def entries(rows: DataFrame, snapshots: DataFrame, objects: DataFrame, *, obj: str, number: str, key: str, updated_at: str, compared: list[Column]) -> DataFrame:
    """One entry per object, snapshot and key. objects: (obj, incremental)."""
    compact = rows.select(F.col(obj), F.col(number), *key_hashes(F.col(key)), F.col(updated_at).cast("bigint").alias("_upd"), row_hash(compared).alias("_row"))
    newest = compact.groupBy(obj, number, "h1", "h2").agg(F.max(F.struct("_upd", "_row")).alias("x"))
    return (
        newest.join(snapshots, [obj, number]).join(objects, obj, "left")
        .select(F.col(obj).alias("object"), "rank", "last", "h1", "h2", F.col("x._row").alias("row"), F.coalesce("incremental", F.lit(False)).alias("incremental"))
    )


def _positions(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted ``keys`` hold ``wanted``, and whether they do."""
    at = np.searchsorted(keys, wanted)
    at = np.minimum(at, max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def diff_object(rank: np.ndarray, key: np.ndarray, row: np.ndarray, ranks: np.ndarray, incremental: bool) -> list[np.ndarray]:
    """Changes (rank, index of key, change, source rank) of one object's entries in a bucket.

    key: the dense number of each entry's key; ``ranks``: all snapshots of the object that the bucket must look at, in order.
    """
    order = np.lexsort((key, rank))
    rank, key, row = rank[order], key[order], row[order]
    edges = np.searchsorted(rank, ranks), np.searchsorted(rank, ranks, side="right")
    out = []
    last_k, last_r, last_rank = key[:0], row[:0], rank[:0]
    for i, (r, lo, hi) in enumerate(zip(ranks, *edges, strict=True)):
        k, v = key[lo:hi], row[lo:hi]
        if i:
            at, known = _positions(last_k, k)
            changed = known.copy()
            if len(last_k):
                changed &= last_r[at] != v
            for mask, what in ((~known, ADDED), (changed, CHANGED)):
                if mask.any():
                    out.append(np.column_stack([np.full(mask.sum(), r), k[mask], np.full(mask.sum(), what), np.full(mask.sum(), r)]))
            if not incremental:
                lost = ~_positions(k, last_k)[1]
                if lost.any():
                    out.append(np.column_stack([np.full(lost.sum(), r), last_k[lost], np.full(lost.sum(), REMOVED), last_rank[lost]]))
        if incremental and len(last_k):
            kept = ~_positions(k, last_k)[1]
            k, v, s = np.concatenate([last_k[kept], k]), np.concatenate([last_r[kept], v]), np.concatenate([last_rank[kept], np.full(hi - lo, r)])
            order = np.argsort(k, kind="stable")
            last_k, last_r, last_rank = k[order], v[order], s[order]
        else:
            last_k, last_r, last_rank = k, v, np.full(hi - lo, r)
    return out


def diff_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    found = []
    for (obj, last, incremental), g in frame.groupby(["object", "last", "incremental"], sort=False):
        h = np.ascontiguousarray(g[["h1", "h2"]].to_numpy(np.int64)).view([("h1", np.int64), ("h2", np.int64)]).ravel()
        order = np.lexsort((h["h2"], h["h1"]))
        s = h[order]
        fresh = np.concatenate([[True], s[1:] != s[:-1]])
        key = np.empty(len(s), np.int64)
        key[order] = np.cumsum(fresh) - 1
        keys = s[fresh]
        parts = diff_object(g["rank"].to_numpy(np.int64), key, g["row"].to_numpy(np.int64), np.arange(1, last + 1), bool(incremental))
        if parts:
            m = np.concatenate(parts)
            found.append(pd.DataFrame({"object": obj, "rank": m[:, 0].astype(np.int32), "h1": keys["h1"][m[:, 1]], "h2": keys["h2"][m[:, 1]], "change": m[:, 2].astype(np.int32), "source_rank": m[:, 3].astype(np.int32)}))
    return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype=t) for c, t in CHANGE_TYPES.items()})


def snapshot_changes(
    rows: DataFrame, objects: DataFrame, *, obj: str, number: str, taken_at: str, key: str, updated_at: str, compared: list[Column], values: list[str], per_bucket: int = 200_000
) -> DataFrame:
    """(obj, number, change_type, values...) of every record added, removed or changed.

    ``objects``: obj and ``incremental`` (true where absence means nothing). ``values``: columns fetched from the row that changed, which for a removed
    record is its last one. ``number`` is that of the later snapshot.
    """
    spark = rows.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // per_bucket))
    snapshots = ordered_snapshots(rows, obj, number, taken_at)
    compact = entries(rows, snapshots, objects, obj=obj, number=number, key=key, updated_at=updated_at, compared=compared)
    changes = compact.withColumn("bucket", F.pmod("h1", F.lit(buckets)).cast("int")).groupBy("bucket").applyInPandas(lambda f: diff_bucket(f), CHANGE)
    full = (
        rows.select(F.col(obj).alias("object"), F.col(number).alias("_no"), *key_hashes(F.col(key)), F.struct(F.col(updated_at).cast("bigint"), row_hash(compared)).alias("_newest"), F.struct(*values).alias("_values"))
        .join(snapshots.select(F.col(obj).alias("object"), F.col(number).alias("_no"), F.col("rank").alias("source_rank")), ["object", "_no"])
        .join(changes, ["object", "source_rank", "h1", "h2"])
        .groupBy("object", "rank", "h1", "h2", "change").agg(F.max_by("_values", "_newest").alias("_values"))
    )
    name = F.element_at(F.create_map(*(x for k, v in NAMES.items() for x in (F.lit(k), F.lit(v)))), F.col("change"))
    at = snapshots.select(F.col(obj).alias("object"), "rank", F.col(number).alias("_number"))
    return full.join(at, ["object", "rank"]).select(F.col("object").alias(obj), F.col("_number").alias(number), name.alias("change_type"), "_values.*")
