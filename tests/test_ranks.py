"""Ranks by ranges, selection that reads the spans it needs, and novelty by blocks, against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.config import Config
from tamis.operators import folds, rank, scoring, select, strata
from tamis.operators.folds import Novelty

KIND = "video_id string, idx long, ml_score double, altitude string, view string, cover string, lighting string"


def test_places(spark):
    rng = np.random.default_rng(0)
    rows = [(k, float(x), i) for i, (k, x) in enumerate(zip(rng.choice(["a"] * 8 + ["b", None], 3000).tolist(), rng.integers(0, 50, 3000).tolist(), strict=True))]
    df = spark.createDataFrame(rows, "k string, x double, i long").repartition(6)
    got = rank.placed(df, ["k"], [F.desc("x"), "i"], "at", "n").collect()
    assert len(got) == 3000
    for key in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2]))
        assert {r["i"]: (r["at"], r["n"]) for r in got if r["k"] == key} == {r[2]: (p, len(own)) for p, r in enumerate(own)}
    alone = rank.placed(df, [], ["i"], "at").collect()
    assert all(r["at"] == r["i"] for r in alone)
    assert rank.placed(df.where("false"), ["k"], ["x"], "at").count() == 0
    for most in (5000, None):
        assert {r["i"]: r["at"] for r in rank.ordered(df, "k", ["x", "i"], "at", most).where("k = 'b'").collect()} == {r[2]: p for p, r in enumerate(sorted((r for r in rows if r[0] == "b"), key=lambda r: r[1:]), 1)}


def test_one_collection_is_spread_over_all_tasks(spark):
    df = spark.range(20_000).select(F.lit("v").alias("k"), F.rand(1).alias("x"), "id")
    dealt = df.repartitionByRange(8, "k", "x").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 5000
    got = rank.placed(df, ["k"], ["x", "id"], "at")
    assert got.agg(F.countDistinct("at"), F.max("at")).first()[:] == (20_000, 19_999)


def plain_selection(rows, size, cfg):
    """(picks, passed over) of rows in rank order, each an index."""
    shares = {k: s for k, _, s in strata.combinations(cfg)}
    n = sparse = 0
    counts, picks, passed = {}, [], []
    for i, score, labels in sorted(rows, key=lambda r: (-r[1], r[0])):
        if n >= size:
            break
        key = "|".join(f"{a}:{v}" for a, v in zip(("altitude", "view", "cover", "lighting"), labels, strict=True))
        is_sparse = labels[2] == "sparse"
        fits = not (is_sparse and n and sparse / n >= cfg.sparse_cap) and ((counts.get(key, 0) / n if n else 0.0) < shares.get(key, 0.0) or score > cfg.high_quality)
        if fits:
            counts[key] = counts.get(key, 0) + 1
            n, sparse = n + 1, sparse + is_sparse
            picks.append(i)
        else:
            passed.append(i)
    return picks, passed


@pytest.mark.parametrize("size", [1, 7, 40, 300])
def test_selection_span_by_span(spark, monkeypatch, size):
    monkeypatch.setattr(scoring, "SPAN", 8)
    rng = np.random.default_rng(size)
    labels = [(a, v, c, x) for a in ("low", "high") for v in ("nadir", "oblique") for c in ("dense", "sparse") for x in ("bright", "dark")]
    rows = [(f"v{k}", i, round(float(rng.random()), 2), *labels[rng.integers(16 if k < 2 else 2)]) for k, n in enumerate((500, 90, 200, 3)) for i in range(n)]
    cfg = Config()
    df = spark.createDataFrame(rows, KIND)
    ranks = select.ranks_of(df)
    assert ranks.agg(F.countDistinct("span")).first()[0] == 4
    got = select.picked(ranks, size, cfg).collect()
    chosen = select.preliminary(df, size, cfg, ranks).collect()
    for k in range(4):
        picks, passed = plain_selection([(r[1], r[2], r[3:]) for r in rows if r[0] == f"v{k}"], size, cfg)
        own = [r for r in got if r["video_id"] == f"v{k}"]
        assert {r["pick"]: r["idx"] for r in own if r["pick"]} == dict(enumerate(picks, 1))
        assert {r["nth"]: r["idx"] for r in own if r["nth"]} == dict(enumerate(passed[:size], 1))
        final = [(r["prelim_ord"], r["idx"], r["phase"]) for r in chosen if r["video_id"] == f"v{k}"]
        assert sorted(final) == [(p, i, 0 if p <= len(picks) else 1) for p, i in enumerate([*picks, *passed][:size], 1)]


def test_spans_after_acceptance_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(scoring, "SPAN", 8)
    rows = [("v", i, 1 - i / 1000, "low", "nadir", "dense", "bright") for i in range(600)]
    ranks = select.ranks_of(spark.createDataFrame(rows, KIND))
    read = []
    plain = folds.materialise

    def watched(df, name, **more):
        read.append(df)
        return plain(df, name, **more)

    monkeypatch.setattr(folds, "materialise", watched)
    cfg = Config(high_quality=0.5)
    assert select.picked(ranks, 5, cfg).where("pick IS NOT NULL").count() == 5 and len(read) == 1
    read.clear()
    assert select.picked(ranks, 20, cfg).where("pick IS NOT NULL").count() == 20 and len(read) == 2


def plain_novelty(vectors, memory, threshold):
    kept, out = [], []
    for e in vectors:
        v = e / (np.linalg.norm(e) + 1e-9)
        n = min(1.0, max(0.0, 1.0 - max(float(p @ v) for p in kept))) if kept else 1.0
        if n > threshold:
            kept.append(v)
            if memory and len(kept) > memory:
                kept.pop(0)
        out.append(n)
    return np.array(out)


@pytest.mark.parametrize("memory", [0, 1, 2, 3, 32, 100])
@pytest.mark.parametrize("threshold", [-0.1, 0.05, 0.4, 2.0])
def test_novelty_by_blocks(memory, threshold):
    rng = np.random.default_rng(memory)
    x = rng.normal(size=(12, 6))[rng.integers(0, 12, 700)] + 0.3 * rng.normal(size=(700, 6))
    x[40] = 0
    fold = Novelty(memory, threshold)
    got = np.concatenate([fold(x[:1]), fold(x[1:130]), fold(x[130:130]), Novelty(memory, threshold, fold.kept)(x[130:])])
    assert np.abs(got - plain_novelty(x, memory, threshold)).max() < 1e-9
