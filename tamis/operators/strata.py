"""Binning into strata, target shares and their evaluation."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.config import Config
from tamis.operators.quantile import exact_quantile

EPSILON = 1e-12


def assign_strata(frames: DataFrame, cfg: Config) -> DataFrame:
    """Adds altitude, view, cover and lighting. The altitude threshold is the exact, linearly interpolated quantile of
    ``hf_energy`` as 32-bit floats over the collection; energies compare as doubles."""
    cut = exact_quantile(frames.select("video_id", F.col("hf_energy").cast("float").alias("hf")), "video_id", "hf", cfg.altitude_quantile, "hf_cut")
    return (
        frames.join(cut, "video_id", "left")
        .withColumn("altitude", F.when(F.col("hf_energy") >= F.col("hf_cut"), "low").otherwise("high"))
        .withColumn("view", F.when(F.col("view_entropy") >= cfg.view_entropy, "nadir").otherwise("oblique"))
        .withColumn("cover", F.when(F.col("green_cover") >= cfg.cover_ratio, "dense").otherwise("sparse"))
        .withColumn("lighting", F.when(F.col("lighting_mean") < cfg.lighting_mean, "dark").otherwise("bright"))
        .drop("hf_cut")
    )


def combo_key() -> Column:
    return F.concat_ws("|", *(F.concat(F.lit(f"{a}:"), F.col(a)) for a in ("altitude", "view", "cover", "lighting")))


def axis_shares(cfg: Config) -> dict[str, dict[str, float]]:
    """Normalised weights of each axis; values that the targets do not mention weigh 1.0, unknown ones are ignored."""
    out = {}
    for axis, values in cfg.axes.items():
        raw = {v: float((cfg.targets or {}).get(axis, {}).get(v, 1.0)) for v in values}
        total = sum(raw.values()) + EPSILON
        out[axis] = {v: w / total for v, w in raw.items()}
    return out


def combinations(cfg: Config) -> list[tuple[str, dict[str, str], float]]:
    """(key, labels, target share) of every combination in the order of the axes; at most the product of their sizes."""
    shares = axis_shares(cfg)
    out = []
    for values in product(*cfg.axes.values()):
        labels = dict(zip(cfg.axes, values, strict=True))
        share = 1.0
        for axis, v in labels.items():
            share *= shares[axis][v]
        out.append(("|".join(f"{a}:{v}" for a, v in labels.items()), labels, share))
    total = sum(s for _, _, s in out) + EPSILON
    return [(k, labels, s / total) for k, labels, s in out]


def compiled_targets(collections: DataFrame, weights: DataFrame, cfg: Config) -> DataFrame:
    """(video_id, combo_ord, combo_key, the axes' labels, ratio) of every combination for each of ``collections(video_id)``,
    from ``weights(video_id, axis, value, weight)``. As in ``axis_shares``, a label without a weight weighs 1.0, and axes
    and labels that the settings do not know are left aside; a collection's combinations are made in its own row."""
    labels = [(a, v) for a, values in cfg.axes.items() for v in values]
    own = F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "axis", "value"), F.col("weight").cast("double"))))
    known = F.concat_ws(":", "axis", "value").isin(*(f"{a}:{v}" for a, v in labels))
    given = weights.where(known & F.col("weight").isNotNull()).groupBy("video_id").agg(own.alias("own"))
    rows = collections.select("video_id").distinct().join(given, "video_id", "left")

    def weight(axis: str, value: str) -> Column:
        return F.coalesce(F.col("own")[f"{axis}:{value}"], F.lit(1.0))

    shares = {}
    for axis, values in cfg.axes.items():
        total = F.lit(0.0)
        for v in values:
            total = total + weight(axis, v)
        shares |= {(axis, v): weight(axis, v) / (total + F.lit(EPSILON)) for v in values}
    made = []
    for k, combo in enumerate(product(*cfg.axes.values())):
        share = F.lit(1.0)
        for axis, v in zip(cfg.axes, combo, strict=True):
            share = share * shares[axis, v]
        key = "|".join(f"{a}:{v}" for a, v in zip(cfg.axes, combo, strict=True))
        made.append(F.struct(F.lit(k).alias("combo_ord"), F.lit(key).alias("combo_key"), *(F.lit(v).alias(a) for a, v in zip(cfg.axes, combo, strict=True)), share.alias("share")))
    grid = rows.select("video_id", F.array(*made).alias("grid"))
    total = F.aggregate("grid", F.lit(0.0), lambda s, g: s + g["share"]) + F.lit(EPSILON)
    each = grid.select("video_id", total.alias("total"), F.explode("grid").alias("g"))
    return each.select("video_id", "g.combo_ord", "g.combo_key", *(F.col(f"g.{a}") for a in cfg.axes), (F.col("g.share") / F.col("total")).alias("ratio"))


def evaluate_targets(selected: DataFrame, cfg: Config) -> DataFrame:
    """For each collection and combination: share, expected count by largest remainder, actual count and shortfall."""
    counted = selected.groupBy("video_id", combo_key().alias("combo_key")).agg(F.count("*").alias("actual"))
    totals = counted.groupBy("video_id").agg(F.sum("actual").alias("total"))
    each = F.array(*(F.struct(F.lit(i).alias("combo_ord"), F.lit(k).alias("combo_key"), F.lit(s).alias("ratio")) for i, (k, _, s) in enumerate(combinations(cfg))))
    grid = totals.withColumn("g", F.explode(each)).select("video_id", "total", "g.*")
    exact = F.col("ratio") * F.col("total")
    share = grid.withColumn("low", F.floor(exact)).withColumn("part", exact - F.floor(exact))
    by = Window.partitionBy("video_id")
    left = share.withColumn("left", F.col("total") - F.sum("low").over(by)).withColumn("nth", F.row_number().over(by.orderBy(F.desc("part"), "combo_ord")))
    expected = left.withColumn("expected", F.col("low") + F.when(F.col("nth") <= F.col("left"), 1).otherwise(0))
    return expected.join(counted, ["video_id", "combo_key"], "left").select(
        "video_id",
        "combo_ord",
        "combo_key",
        "ratio",
        F.col("expected").cast("long").alias("expected"),
        F.coalesce("actual", F.lit(0)).alias("actual"),
        F.greatest(F.lit(0), F.col("expected") - F.coalesce("actual", F.lit(0))).cast("long").alias("shortfall"),
    )


def targets_result(evaluated: DataFrame, pool: DataFrame) -> DataFrame:
    """For each collection of ``pool``: the totals of its evaluated targets, and ``success``, that none falls short."""
    candidates = pool.groupBy("video_id").agg(F.count("*").alias("candidates_count"))
    sums = evaluated.groupBy("video_id").agg(*(F.sum(c).alias(f"total_{c}") for c in ("expected", "actual", "shortfall")))
    totals = [F.coalesce(f"total_{c}", F.lit(0)).alias(f"total_{c}") for c in ("expected", "actual", "shortfall")]
    out = candidates.join(sums, "video_id", "left").select("video_id", "candidates_count", *totals)
    return out.withColumn("selected_count", F.col("total_actual")).withColumn("success", F.col("total_shortfall") == 0)


def strata_distribution(frames: DataFrame) -> DataFrame:
    return frames.groupBy("altitude", "view", "cover", "lighting").agg(F.count("*").alias("n"))


def axes_summary(frames: DataFrame) -> DataFrame:
    """Counts of each label of each axis in one pass."""
    pairs = F.array(*(F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in ("altitude", "view", "cover", "lighting")))
    return frames.select(F.explode(pairs).alias("p")).groupBy("p.axis", "p.value").agg(F.count("*").alias("n"))


def satisfaction(selected: DataFrame, cfg: Config, normalised: bool) -> DataFrame:
    """Actual and target share of every configured label. The report compares raw weights, with a tolerance of 0.001;
    the web table normalised ones, without."""
    shares = axis_shares(cfg)
    rows = []
    for axis, values in cfg.axes.items():
        for v in sorted(values):
            raw = (cfg.targets or {}).get(axis, {}).get(v)
            rows.append((axis, v, shares[axis][v] if normalised else float(raw) if raw is not None else 1.0 / len(values)))
    goals = selected.sparkSession.createDataFrame(rows, "axis string, value string, target double")
    total = selected.agg(F.count("*").alias("total"))
    actual = axes_summary(selected)
    out = goals.join(actual, ["axis", "value"], "left").crossJoin(F.broadcast(total))  # one row
    share = F.coalesce("n", F.lit(0)) / F.greatest("total", F.lit(1))
    return out.select("axis", "value", "target", share.alias("actual"), (share >= F.col("target") - F.lit(0.0 if normalised else 0.001)).alias("satisfied"))
