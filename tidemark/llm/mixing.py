"""Mixing sources to target weights.

Quotas: a source may give at most its tokens times its repeats. With ``fill`` the mix is as large as asked, and what a source can't give goes to the others in proportion to
their targets, until nothing is left to give; without it the sources that have documents stand exactly in proportion to their targets, and the mix is only as large as the scarcest of them allows.

Blocks: a source's documents are hashed into blocks of about ``docs_per_block``, whatever its size. Its quota is whole passes over all its blocks and a part pass over the
first blocks of a permutation (a seeded hash), so no document appears more often than allowed and shares are exact to half a block. Where the part pass ends is found by radix descent over the permutation's values.

Shards: the drawn blocks are divided among the output shards by a splitting tree. Each node divides its count of blocks, source by source, between its halves by a
multivariate hypergeometric draw, as if all drawn blocks had been shuffled; leaves then hold exact quotas that sum to the totals. Each
source's drawn blocks are permuted anew and handed out in that order, so shards are disjoint, and a shard's documents are shuffled within it.

Defined cases: documents of a null or unknown source, and sources without target, documents or repeats, are not drawn; null repeats count as one;
targets needn't sum to one; where nothing may be drawn the mix is empty; empty documents belong to blocks and come along with 0 tokens; repeated rows are
drawn like others; equal weights and sizes need no order, since every draw is seeded.

Scale: blocks, their permutations and shards are tables; the driver sees one row per target (its quota and counts) and the top of the tree, and executors split its lower nodes. There are as many shards as the mix needs to
have about ``docs_per_shard`` documents in each, so the shuffle within a shard is a sort of that many. No texts move: a mix is keys with shard, position and copy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.increment import in_interval
from tidemark.operators.profile import ranks
from tidemark.runtime import materialise

#: Nodes that the driver splits before executors go on, and the count of blocks up to which a draw is hypergeometric (the library's bound).
TOP, LARGEST = 256, 10**9 - 1
PER_RUN = 4096


@dataclass(frozen=True)
class MixSettings:
    docs_per_block: int = 16
    least_blocks: int = 4096  # so that half a block is little of a small source too
    docs_per_shard: int = 10_000
    shards: int | None = None  # by default as many as docs_per_shard asks for
    seed: int = 20240801


def quotas(size: float, shares: np.ndarray, available: np.ndarray, repeats: np.ndarray, fill: bool = True) -> np.ndarray:
    """Tokens that each source gives: its target where it can; with ``fill`` what is missing is shared among those that can give more, else the whole mix shrinks."""
    most = available * repeats
    given, open_ = np.zeros(len(shares)), (most > 0) & (shares > 0)
    if not fill:
        if not open_.any():
            return given
        weights = np.where(open_, shares, 0) / shares[open_].sum()
        return weights * min(size, float((most[open_] / weights[open_]).min()))
    while open_.any() and size - given.sum() > 1e-9 * max(size, 1):
        want = given + np.where(open_, shares, 0) / shares[open_].sum() * (size - given.sum())
        given = np.where(open_, np.minimum(want, most), given)
        open_ &= given < most * (1 - 1e-12)
    return given


def draw(counts: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``n`` blocks are of each source. Beyond what the library draws from, each source gives its proportion, and chance decides the remainders."""
    total = int(counts.sum())
    if total == 0 or n == 0:
        return np.zeros_like(counts)
    if total <= LARGEST:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    exact = [int(c) * n / total for c in counts]
    out = np.array([int(c) * n // total for c in counts])
    for i in np.argsort(rng.random(len(out)) - (np.array(exact) - out))[: n - int(out.sum())]:
        out[i] += 1
    return out


def halves(counts: np.ndarray, lo: int, hi: int, seed: int) -> list[tuple[np.ndarray, int, int]]:
    """The two nodes below the one with shards lo to hi: blocks in proportion to shards, sources by chance."""
    left = (hi - lo) // 2
    a = draw(counts, int(counts.sum()) * left // (hi - lo), np.random.default_rng([seed, lo, hi]))
    return [(a, lo, lo + left), (counts - a, lo + left, hi)]


def split(counts: np.ndarray, shards: int, seed: int, lo: int = 0) -> np.ndarray:
    """shards x sources counts that sum to ``counts``; shards hold equal numbers of blocks, but for one or two."""
    if shards == 1:
        return counts[None, :]
    return np.vstack([split(c, b - a, seed, a) for c, a, b in halves(counts, lo, lo + shards, seed)])


def shard_quotas(spark, sources: list[str], counts: np.ndarray, shards: int, seed: int) -> DataFrame:
    """(source, shard, n) of the tree's leaves. The driver splits the top, executors what lies below."""
    nodes = [(counts, 0, shards)]
    while len(nodes) < min(TOP, shards):
        nodes = [x for c, a, b in nodes for x in (halves(c, a, b, seed) if b - a > 1 else [(c, a, b)])]
    top = spark.createDataFrame([([int(x) for x in c], a, b) for c, a, b in nodes], "counts array<bigint>, lo bigint, hi bigint")

    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for x in f.itertuples():
                grid = split(np.array(x.counts, np.int64), x.hi - x.lo, seed, x.lo)
                shard, source = np.nonzero(grid)
                yield pd.DataFrame({"source": [sources[i] for i in source], "shard": shard + x.lo, "n": grid[shard, source]})

    return top.repartition(max(1, min(len(nodes), spark.sparkContext.defaultParallelism))).mapInPandas(leaves, "source string, shard bigint, n bigint")


def numbered(rows: DataFrame, group: str, order: Column, sizes: Column) -> DataFrame:
    """``rows`` with _pos, their place (from 1) in their group by a hash. The hash range is cut into runs of about PER_RUN rows, so that no window holds a whole group; ``sizes``: rows of the group."""
    runs = F.greatest(F.ceil(sizes / PER_RUN), F.lit(1)).cast("bigint")
    cut = rows.withColumn("_order", order).withColumn("_run", F.shiftrightunsigned(F.shiftrightunsigned("_order", 33) * runs, 31))
    inner = cut.withColumns({"_in": F.row_number().over(Window.partitionBy(group, "_run").orderBy("_order", "_block", "copy"))})
    before = cut.groupBy(group, "_run").agg(F.count("*").alias("_k"))
    before = before.withColumn("_before", F.sum("_k").over(Window.partitionBy(group).orderBy("_run")) - F.col("_k")).drop("_k")
    return inner.join(before, [group, "_run"]).withColumn("_pos", F.col("_before") + F.col("_in")).drop("_order", "_run", "_in", "_before")


def source_plan(counted: DataFrame, targets: DataFrame, source: str, size: float | None, settings: MixSettings, fill: bool) -> pd.DataFrame:
    """One row per target: source, share, repeats, tokens, docs, quota, passes and rest of the quota, number of blocks."""
    wanted = targets.filter(F.col(source).isNotNull() & (F.col("target_share") > 0)).groupBy(source).agg(F.max("target_share").alias("share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("repeats"))
    held = counted.groupBy(source).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    p = wanted.join(held, source, "left").fillna(0, ["tokens", "docs"]).toPandas().rename(columns={source: "source"}).sort_values("source").reset_index(drop=True)
    if size is None:
        size = float(counted.agg(F.sum("n_tokens")).first()[0] or 0)
    p["quota"] = quotas(float(size), p["share"].to_numpy(float), p["tokens"].to_numpy(float), p["repeats"].to_numpy(float), fill)
    whole = np.where(p["tokens"] > 0, np.floor(p["quota"] / p["tokens"].clip(lower=1) + 1e-9), 0)
    p["passes"] = np.minimum(whole, p["repeats"]).astype(np.int64)
    p["rest"] = np.where(p["passes"] < p["repeats"], np.ceil(p["quota"] - p["passes"] * p["tokens"] - 1e-6), 0).clip(min=0).astype(np.int64)
    p["blocks"] = np.maximum(-(-p["docs"] // settings.docs_per_block), np.minimum(settings.least_blocks, p["docs"])).clip(lower=1).astype(np.int64)
    return p


def drawn_blocks(blocks: DataFrame, plan: DataFrame, source: str) -> DataFrame:
    """(source, _block, copy): every drawn copy of a block. blocks: source, _block, _r (its place in the permutation) and tokens."""
    cut = ranks(blocks, [source], "_r", "tokens", plan.filter("rest > 0").select(source, F.col("rest").alias("rank"))).select(source, F.col("value").alias("_edge"))
    near = blocks.join(cut, source).groupBy(source, "_edge").agg(F.sum(F.when(F.col("_r") < F.col("_edge"), F.col("tokens")).otherwise(0)).alias("_under"), F.sum(F.when(F.col("_r") == F.col("_edge"), F.col("tokens")).otherwise(0)).alias("_at"))
    # the block at the edge comes along if the quota is met more closely with it
    near = near.join(plan.select(source, "rest"), source).select(source, "_edge", (F.col("_under") + F.col("_at") - F.col("rest") <= F.col("rest") - F.col("_under")).alias("_with"))
    part = (F.col("_r") < F.col("_edge")) | ((F.col("_r") == F.col("_edge")) & F.col("_with"))
    times = F.col("passes") + F.when(F.coalesce(part, F.lit(False)), 1).otherwise(0)
    every = blocks.join(plan.select(source, "passes"), source).join(near, source, "left").withColumn("_times", times).filter("_times > 0")
    return every.select(source, "_block", "docs", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_times").cast("bigint") - 1)).alias("copy"))


def mix(counted: DataFrame, targets: DataFrame, *, key: str, source: str, size: float | None = None, settings: MixSettings = MixSettings(), fill: bool = True) -> DataFrame:
    """(shard, position, key, source, copy, n_tokens): the mix. ``counted``: key, source and n_tokens; ``targets``: source, target_share, max_repeats; ``size``: tokens, by default those of the corpus."""
    spark, s = counted.sparkSession, settings
    empty = counted.select(F.lit(0).cast("bigint").alias("shard"), F.lit(0).alias("position"), key, source, F.lit(0).cast("bigint").alias("copy"), "n_tokens").limit(0)
    p = source_plan(counted, targets, source, size, settings, fill)
    p = p[(p["passes"] > 0) | (p["rest"] > 0)]
    if p.empty:
        return empty
    plan = spark.createDataFrame([(r.source, int(r.blocks), int(r.passes), int(r.rest)) for r in p.itertuples()], f"{source} string, _blocks bigint, passes bigint, rest bigint")
    items = counted.select(key, source, "n_tokens").join(plan.select(source, "_blocks"), source).withColumn("_block", F.pmod(F.xxhash64(F.lit(s.seed), F.col(key)), F.col("_blocks"))).drop("_blocks")
    blocks = items.groupBy(source, "_block").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")).withColumn("_r", F.shiftrightunsigned(F.xxhash64(F.lit(s.seed + 1), source, "_block"), 1))
    drawn = materialise(drawn_blocks(materialise(blocks, "mix-blocks"), plan, source), "mix-drawn")
    sums = drawn.groupBy(source).agg(F.count("*").alias("n"), F.sum("docs").alias("docs")).orderBy(source).collect()  # one row per source
    if not sums:
        return empty
    shards = s.shards or max(1, -(-sum(r.docs for r in sums) // s.docs_per_shard))
    shares = shard_quotas(spark, [r[source] for r in sums], np.array([r.n for r in sums], np.int64), shards, s.seed)
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("shard"))
    spans = materialise(shares.withColumn("_upto", upto).select(F.col("source").alias("_obj"), (F.col("_upto") - F.col("n")).alias("_after"), "_upto", "shard"), "mix-shards")
    sized = drawn.join(spark.createDataFrame([(r[source], r.n) for r in sums], f"{source} string, _n bigint"), source)
    placed = numbered(sized, source, F.xxhash64(F.lit(s.seed + 2), source, "_block", "copy"), F.col("_n")).drop("_n", "docs")
    assigned = in_interval(placed, spans, obj=source, value=F.col("_pos")).select(F.col(source).alias("_source"), F.col("_block").alias("_number"), "copy", "shard")
    chosen = items.join(assigned, (F.col(source) == F.col("_source")) & (F.col("_block") == F.col("_number"))).select("shard", key, source, "copy", "n_tokens")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(s.seed + 3), key, "copy"), key, "copy")
    return chosen.withColumn("position", F.row_number().over(local)).select("shard", "position", key, source, "copy", "n_tokens")


def report(mixed: DataFrame, counted: DataFrame, targets: DataFrame, source: str) -> DataFrame:
    """One row per target: its share, what was there, what was drawn, the most copies of one document, and why its share is what it is."""
    total = F.sum("mix_tokens").over(Window.partitionBy(F.lit(1)))  # over one row per target
    drawn = mixed.groupBy(source).agg(F.sum("n_tokens").alias("mix_tokens"), F.count("*").alias("mix_rows"), (F.max("copy") + 1).alias("most_copies"))
    there = counted.groupBy(source).agg(F.sum("n_tokens").alias("tokens"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    wide = targets.join(there, source, "left").join(drawn, source, "left").select(source, "target_share", "max_repeats", zero("tokens"), zero("mix_tokens"), zero("mix_rows"), zero("most_copies"))
    actual = F.when(total > 0, F.round(F.col("mix_tokens") / total, 6)).otherwise(0.0)
    reason = (
        F.when(F.col("tokens") == 0, "no documents")
        .when(F.abs(F.col("actual_share") - F.col("target_share")) <= 0.005, "target met")
        .when(F.col("actual_share") < F.col("target_share"), "all that max_repeats allows")
        .otherwise("takes what capped sources lack")
    )
    return wide.withColumn("actual_share", actual).withColumn("reason", reason)
