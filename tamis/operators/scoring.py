"""Prefilter, quality score and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tamis.config import Config
from tamis.functions.image import ImageSettings
from tamis.functions.vectors import clamp01, scale
from tamis.operators.rank import placed
from tamis.storage import materialise


def stride(frames: DataFrame, step: int) -> DataFrame:
    return frames.where(F.col("idx") % (step or 1) == 0)


def timestamps(frames: DataFrame, fps: float | None, fallback: float = 30.0) -> DataFrame:
    return frames.withColumn("t_sec", F.col("idx") / F.lit(float(fps or fallback)))


def prefilter(frames: DataFrame, cfg: Config) -> DataFrame:
    """Keeps what reaches both minima; frames without a number in either are rejected."""
    return frames.where(
        (F.col("sharpness") >= cfg.min_sharpness) & (F.col("contrast") >= cfg.min_contrast) & ~F.isnan("sharpness") & ~F.isnan("contrast")
    )


def prefilter_counts(frames: DataFrame, cfg: Config) -> DataFrame:
    """One row: frames seen, kept and filtered out by the minima."""
    kept = (F.col("sharpness") >= cfg.min_sharpness) & (F.col("contrast") >= cfg.min_contrast) & ~F.isnan("sharpness") & ~F.isnan("contrast")
    return frames.agg(F.count("*").alias("seen"), F.count_if(kept).alias("kept"), F.count_if(~F.coalesce(kept, F.lit(False))).alias("filtered"))


def observed_prefilter(frames: DataFrame, cfg: Config) -> tuple[DataFrame, Observation, Observation]:
    """``prefilter`` with counters of the frames seen and kept, which fill as the plan runs, without a pass of their own."""
    seen, kept = Observation(), Observation()
    one = F.count(F.lit(1)).alias("n")
    return prefilter(frames.observe(seen, one), cfg).observe(kept, one), seen, kept


def quality(cfg: Config) -> Column:
    a, b, c, d = cfg.components
    return (
        F.lit(a) * scale(F.col("sharpness"), *cfg.sharpness_range)
        + F.lit(b) * scale(F.col("contrast"), *cfg.contrast_range)
        + F.lit(c) * F.col("exposure_score")
        + F.lit(d) * F.col("noise_score")
    )


def exposure_score(mean: Column, under: Column, over: Column, s: ImageSettings | None = None) -> Column:
    s = s or ImageSettings()
    off = F.lit(s.center_weight) * F.abs(mean - F.lit(s.center)) / F.lit(s.center)
    return clamp01(1 - F.least(F.lit(1.0), off + F.lit(s.clip_weight) * F.lit(s.clip_multiplier) * (under + over)))


#: Ranks of the first span; every next one reaches four times as far.
SPAN = 4096


def ranked(scored: DataFrame, by: str = "ml_score", total: str | None = None) -> DataFrame:
    """Adds ``rank`` from 1 in each collection, best first, ties by ``idx``, and the collection's rows as ``total``."""
    return placed(scored, ["video_id"], [F.desc(by), "idx"], "rank", total).withColumn("rank", F.col("rank") + 1)


def ranking(scored: DataFrame) -> DataFrame:
    """``ranked`` with totals, written once, its files parted by spans of ranks."""
    ends = F.array(*(F.lit(SPAN * 4**k).cast("long") for k in range(25)))
    return materialise(ranked(scored, total="total").withColumn("span", F.size(F.filter(ends, lambda e: e < F.col("rank")))), "ranking", by="span")


def of_fraction(ranks: DataFrame, ratio: float, total: str = "total") -> DataFrame:
    """The best max(1, floor(n * ratio)) of each collection of ``ranked`` rows with totals."""
    return ranks.where(F.col("rank") <= F.greatest(F.lit(1), F.floor(F.col(total) * F.lit(float(ratio)))))


def top_fraction(scored: DataFrame, ratio: float, by: str = "ml_score") -> DataFrame:
    """The best max(1, floor(n * ratio)) of each collection, with their rank."""
    return of_fraction(ranked(scored, by, "__total"), ratio, "__total").drop("__total")
