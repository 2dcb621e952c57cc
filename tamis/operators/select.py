"""Stratified selection, fills and final order. No step numbers or sorts a whole collection in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.config import Config
from tamis.operators.folds import stratified_ranges
from tamis.operators.rank import ordered
from tamis.operators.scoring import of_fraction, ranking
from tamis.operators.strata import combinations, combo_key

#: What selection needs of a frame; vectors and metrics are fetched for the chosen frames alone.
NARROW = ("video_id", "idx", "ml_score", "altitude", "view", "cover", "lighting")


def ranks_of(binned: DataFrame) -> DataFrame:
    """The ranking that selections and fills share: ``NARROW``, ``combo_key``, ``rank``, ``total`` and ``span``, written."""
    return ranking(binned.select(*NARROW).withColumn("combo_key", combo_key()))


def picked(ranks: DataFrame, size: int, cfg: Config) -> DataFrame:
    """(video_id, idx, rank, pick, nth): see ``stratified_ranges``."""
    return stratified_ranges(ranks, {k: s for k, _, s in combinations(cfg)}, size, cfg)


def stratified_select(binned: DataFrame, size: int, cfg: Config) -> DataFrame:
    """Accepted frames of each collection, in rank order, at most ``size``; only their ``NARROW`` columns, with rank and key."""
    ranks = ranks_of(binned)
    return ranks.drop("total", "span").join(picked(ranks, size, cfg).where("pick IS NOT NULL").select("video_id", "idx"), ["video_id", "idx"], "left_semi")


def preliminary(binned: DataFrame, size: int | None, cfg: Config, ranks: DataFrame | None = None) -> DataFrame:
    """The selection before removal of duplicates, with ``rank``, ``phase`` and ``prelim_ord``: the top fraction without a
    size, else the stratified picks (phase 0) and, where a collection is short of ``size``, its best frames passed over."""
    ranks = ranks_of(binned) if ranks is None else ranks
    phase = lambda n: F.lit(n).alias("phase")
    if size is None:
        out = of_fraction(ranks, cfg.selection_ratio).select("video_id", "idx", "rank", phase(0), F.col("rank").alias("prelim_ord"))
    else:
        seen = picked(ranks, size, cfg)
        picks = seen.where("pick IS NOT NULL").select("video_id", "idx", "rank", phase(0), F.col("pick").alias("prelim_ord"))
        have = picks.groupBy("video_id").agg(F.count("*").alias("have"))
        passed = seen.where("nth IS NOT NULL").join(have, "video_id", "left").withColumn("prelim_ord", F.coalesce("have", F.lit(0)) + F.col("nth"))
        out = picks.unionByName(passed.where(F.col("prelim_ord") <= size).select("video_id", "idx", "rank", phase(1), "prelim_ord"))
    return binned.join(out, ["video_id", "idx"])


def final_order(kept: DataFrame, pool: DataFrame, size: int | None, ranks: DataFrame | None = None) -> DataFrame:
    """Survivors, filled up again from ``pool`` (removed duplicates included) where short, best scores first. The frames
    that can fill are among the first ``size`` ranks of their collection."""
    out = kept.select("video_id", "idx", "ml_score", "rank", "prelim_ord", F.lit(0).alias("phase"))
    if size is not None:
        best = (ranks_of(pool) if ranks is None else ranks).where(F.col("rank") <= size).select("video_id", "idx", "ml_score", "rank")
        have = out.groupBy("video_id").agg(F.count("*").alias("have"))
        missing = ordered(best.join(out.select("video_id", "idx"), ["video_id", "idx"], "left_anti"), "video_id", ["rank"], "nth", size)
        more = missing.join(have, "video_id", "left").where(F.col("nth") <= F.lit(size) - F.coalesce("have", F.lit(0)))
        out = out.unionByName(more.drop("nth", "have").withColumn("phase", F.lit(1)), allowMissingColumns=True)
    out = ordered(out, "video_id", [F.desc("ml_score"), "phase", F.coalesce("prelim_ord", "rank"), "idx"], "final_ord", None if size is None else 2 * size)
    out = out if size is None else out.where(F.col("final_ord") <= size)
    return pool.join(out.select("video_id", "idx", "rank", "prelim_ord", "phase", "final_ord"), ["video_id", "idx"])
