"""Curation end to end: prefilter, score, bin, select, remove duplicates, fill and write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.config import Config
from tamis.operators import scoring, select, similarity, strata
from tamis.operators.folds import score_frames
from tamis.operators.quantile import exact_quantile
from tamis.operators.rank import ordered
from tamis.sources.images import file_name, write_frames
from tamis.storage import materialise

__all__ = ["candidates", "curate", "file_name", "score_stats", "select_from", "selection_ratio", "tile_filter", "without_duplicates", "write_frames"]


def candidates(frames: DataFrame, cfg: Config) -> DataFrame:
    """Prefiltered, scored and binned frames, written once since every later stage reads them."""
    return materialise(strata.assign_strata(score_frames(scoring.prefilter(frames, cfg), cfg), cfg), "candidates")


def without_duplicates(chosen: DataFrame, cfg: Config, method: str | None = None, size: int | None = None) -> DataFrame:
    """Survivors of greedy selection, or the best of each density cluster (only the method "dbscan" clusters). ``size`` is
    the most frames of a collection, where there is a limit."""
    if (method or cfg.duplicates_method or "greedy").lower() == "dbscan":
        nodes = chosen.select("video_id", F.col("prelim_ord").alias("ord"), "embed", "ml_score")
        eps = similarity.auto_eps(nodes, *cfg.eps_bounds) if cfg.eps is None else cfg.eps
        labelled = similarity.dbscan(nodes, eps, cfg.min_samples)
        best = similarity.representatives(labelled.join(nodes.drop("embed"), ["video_id", "ord"]))
        kept = best.select("video_id", F.col("ord").alias("prelim_ord"))
    else:
        narrow = chosen.select("video_id", "prelim_ord", "ml_score", "embed")
        nodes = ordered(narrow, "video_id", [F.desc("ml_score"), "prelim_ord"], "ord", size).select("video_id", "ord", "prelim_ord", "embed")
        kept = similarity.greedy_select(nodes, cfg.cosine_threshold).join(nodes.select("video_id", "ord", "prelim_ord"), ["video_id", "ord"]).select("video_id", "prelim_ord")
    return chosen.join(kept, ["video_id", "prelim_ord"], "left_semi")


def curate(frames: DataFrame, cfg: Config, target_size: int | None = None, method: str | None = None) -> DataFrame:
    """The final frames of each collection with ``final_ord``; without candidates the result is empty."""
    return select_from(candidates(frames, cfg), cfg, target_size, method)


def select_from(pool: DataFrame, cfg: Config, target_size: int | None = None, method: str | None = None) -> DataFrame:
    """``curate`` from candidates that are written already. One ranking serves selection and both fills."""
    ranks = select.ranks_of(pool)
    chosen = materialise(select.preliminary(pool, target_size, cfg, ranks), "chosen")
    kept = without_duplicates(chosen, cfg, method, target_size)
    return select.final_order(kept, pool, target_size, ranks)


def score_stats(selected: DataFrame) -> DataFrame:
    s = F.col("ml_score")
    sums = selected.agg(F.count("*").alias("n"), F.avg(s).alias("mean"), F.min(s).alias("low"), F.max(s).alias("high"))
    middle = exact_quantile(selected.select(F.lit(1).alias("all"), "ml_score"), "all", "ml_score", 0.5, "median").select("median")
    return sums.join(F.broadcast(middle), how="left").select("n", "mean", "median", "low", "high")  # one row each


def selection_ratio(pool: DataFrame, selected: DataFrame) -> DataFrame:
    a = pool.groupBy("video_id").agg(F.count("*").alias("candidates"))
    b = selected.groupBy("video_id").agg(F.count("*").alias("selected"))
    return a.join(b, "video_id", "left").select("video_id", "candidates", F.coalesce("selected", F.lit(0)).alias("selected"), (F.coalesce("selected", F.lit(0)) / F.col("candidates")).alias("ratio"))


def tile_filter(selected: DataFrame, tags: list[str]) -> DataFrame:
    """Frames that carry any of the ``axis:value`` tags; no tag shows none."""
    own = F.array(*(F.concat(F.lit(f"{a}:"), F.col(a)) for a in ("altitude", "view", "cover", "lighting")))
    return selected.where(F.arrays_overlap(own, F.array(*(F.lit(t) for t in tags)).cast("array<string>")))
