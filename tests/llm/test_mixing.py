import numpy as np
import pytest

from tests.conftest import rows
from tidemark.llm.mixing import MixSettings, draw, mix, quotas, report, split


def test_quotas_fill_what_capped_sources_lack():
    q = quotas(100, np.array([0.5, 0.3, 0.2]), np.array([10.0, 100.0, 100.0]), np.array([2.0, 1.0, 1.0]))
    assert np.allclose(q, [20, 48, 32])
    assert np.allclose(quotas(1000, np.array([0.5, 0.5]), np.array([10.0, 20.0]), np.array([1.0, 2.0])), [10, 40])
    assert quotas(10, np.array([1.0]), np.array([0.0]), np.array([3.0])).sum() == 0


def test_exact_quotas_shrink_the_mix():
    q = quotas(100, np.array([0.5, 0.3, 0.2]), np.array([10.0, 100.0, 100.0]), np.array([2.0, 1.0, 1.0]), fill=False)
    assert np.allclose(q, [20, 12, 8])
    assert quotas(10, np.array([0.5, 0.5]), np.array([0.0, 9.0]), np.array([3.0, 3.0]), fill=False).tolist() == [0, 10]
    assert quotas(10, np.array([1.0]), np.array([0.0]), np.array([3.0]), fill=False).sum() == 0


@pytest.mark.parametrize("shards", [1, 6, 200])
def test_splitting_tree_is_exact_and_even(shards):
    counts = np.array([1000, 0, 70, 330])
    leaves = split(counts, shards, 2)
    assert (leaves.sum(0) == counts).all() and leaves.min() >= 0 and leaves.sum(1).max() - leaves.sum(1).min() <= 2


def test_draws_beyond_the_librarys_bound():
    counts = np.array([3 * 10**9, 10**9 + 1, 5])
    got = draw(counts, 2 * 10**9, np.random.default_rng(1))
    assert got.sum() == 2 * 10**9 and abs(got[0] - 1.5 * 10**9) <= 2 and (got <= counts).all()


@pytest.fixture(scope="module")
def corpus(spark):
    data = [(i, ["big", "big", "big", "small", None, "untargeted"][i % 6], i % 13, "x") for i in range(1200)]
    counted = spark.createDataFrame(data, "doc_id long, source string, n_tokens long, shard string").drop("shard")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("absent", 0.1, 9), ("off", 0.0, 2), (None, 0.1, 2), ("nocap", 0.0, None)], "source string, target_share double, max_repeats long")
    return counted, targets


def test_mix(spark, corpus):
    counted, targets = corpus
    out = mix(counted, targets, key="doc_id", source="source", settings=MixSettings(shards=5, docs_per_block=4))
    got = out.collect()
    assert {r.source for r in got} == {"big", "small"}
    per_doc = {}
    for r in got:
        per_doc.setdefault((r.source, r.doc_id), []).append(r["copy"])
    assert all(sorted(c) == list(range(len(c))) for c in per_doc.values())
    assert max(len(c) for (s, _), c in per_doc.items() if s == "big") <= 1 and max(len(c) for (s, _), c in per_doc.items() if s == "small") <= 3
    assert {r.shard for r in got} == set(range(5))
    for shard in range(5):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.position for r in own) == list(range(1, len(own) + 1))
    total = {s: sum(r.n_tokens for r in counted.filter(f"source = '{s}'").collect()) for s in ("big", "small")}
    drawn = {s: sum(r.n_tokens for r in got if r.source == s) for s in ("big", "small")}
    assert drawn == {"big": total["big"], "small": 3 * total["small"]}  # both at their cap
    again = mix(counted.repartition(7), targets, key="doc_id", source="source", settings=MixSettings(shards=5, docs_per_block=4))
    assert rows(again) == rows(out)
    shares = {r.source: r for r in report(out, counted, targets, "source").collect()}
    assert abs(shares["small"].actual_share - drawn["small"] / sum(drawn.values())) < 1e-6 and shares["absent"].mix_rows == 0


def test_target_shares_are_reached_below_the_caps(spark, corpus):
    counted, targets = corpus
    out = mix(counted, targets, key="doc_id", source="source", size=2000, settings=MixSettings(shards=2, docs_per_block=1))
    drawn = {r[0]: r[1] for r in out.groupBy("source").sum("n_tokens").collect()}
    assert abs(drawn["big"] - 2000 * 5 / 9) <= 30 and abs(drawn["small"] - 2000 * 4 / 9) <= 30


def test_many_shards_and_sources(spark):
    """200 shards of 50 sources: every copy has one place, shards are even, and shares hold; none of it goes by the driver's tables."""
    data = [(i, f"s{i % 50}", 10) for i in range(12_000)]
    counted = spark.createDataFrame(data, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([(f"s{i}", 0.03 if i < 10 else 0.0175, 4) for i in range(50)], "source string, target_share double, max_repeats long")
    got = mix(counted, targets, key="doc_id", source="source", settings=MixSettings(docs_per_shard=60, docs_per_block=1)).toPandas()
    assert abs(len(got) - 12_000) <= 50 and got["shard"].nunique() >= 200 and not got.duplicated(["doc_id", "copy"]).any()
    assert got.groupby("shard").size().max() <= 140
    assert abs(got[got["source"] == "s3"]["n_tokens"].sum() / 120_000 - 0.03) < 0.001
    assert got.groupby("shard")["position"].agg(["min", "max", "count"]).eval("min == 1 and max == count").all()


def test_exact_mode_meets_the_shares(spark, corpus):
    counted, _ = corpus
    targets = spark.createDataFrame([("big", 0.2, 1), ("small", 0.8, 2)], "source string, target_share double, max_repeats long")
    settings = MixSettings(docs_per_block=1)
    shares = {r.source: r for r in report(mix(counted, targets, key="doc_id", source="source", settings=settings, fill=False), counted, targets, "source").collect()}
    assert abs(shares["small"].actual_share - 0.8) < 0.005 and shares["small"].reason == "target met" and shares["small"].most_copies == 2


def test_empty(spark, corpus):
    counted, targets = corpus
    assert mix(counted.limit(0), targets, key="doc_id", source="source").collect() == []
    assert mix(counted, targets.limit(0), key="doc_id", source="source").collect() == []
