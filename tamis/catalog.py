"""All queries of the curation engine by name, with their SQL.

Each query runs over the whole derived view of its table; floating-point results are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis import config
from tamis import oracle as sql
from tamis.config import Config
from tamis.functions import image
from tamis.functions.vectors import normalised, scale
from tamis.operators import folds, scoring, select, similarity, strata
from tamis.plans import curate, manifest, runs
from tamis.sources import frames
from tamis.storage import materialise, scratch
from tamis.streaming.novelty import STATE_STORE, score_late_stream, score_stream

#: Target weights of the shipped settings.
TARGETS = {
    "altitude": {"low": 0.5, "high": 0.5},
    "view": {"nadir": 0.5, "oblique": 0.5},
    "cover": {"dense": 0.7, "sparse": 0.3},
    "lighting": {"bright": 0.6, "dark": 0.4},
}
CFG = Config(
    targets=TARGETS, limits={"sparse_max_ratio": 0.30}, novelty_memory=32, novelty_threshold=0.7, high_quality=0.80, cosine_threshold=0.30, eps=0.65
)
PARTIAL = CFG.with_(targets={"cover": {"sparse": 0.6}})
IMAGE = image.ImageSettings(noise_scale=60.0, green_threshold=0.6, lowres=(4, 4))
IMAGE_CFG = CFG.with_(min_sharpness=19500.5, min_contrast=31.01, sharpness_range=(15000.0, 32000.0), contrast_range=(28.0, 37.0), view_entropy=1.951, cover_ratio=0.33, lighting_mean=127.01)
SIZE = 12

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def _query(text: str | None):
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if text:
            _sql[f.__name__] = text
        return f

    return add


def _with(*parts: str) -> str:
    """Common table expressions, then the query."""
    last = parts[-1]
    return "WITH RECURSIVE " + ",\n".join(parts[:-1]) + ("\n" if last.startswith("SELECT") else ",\n") + last


def _r(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


def _rs(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


LABELS = ("altitude", "view", "cover", "lighting")
_PRE = (sql.light(), sql.prefiltered(CFG))
_SCORED = (*_PRE, sql.scored(CFG))
_BINNED = (*_SCORED, sql.binned(CFG), sql.RANKED)
_CHOSEN = (*_BINNED, sql.stratified(CFG, SIZE), sql.filled(SIZE))
_FINAL = (*_CHOSEN, sql.NODES, sql.greedy("nodes", CFG.cosine_threshold), sql.LEFT_OVER, sql.refill(SIZE))


def _pool(spark: SparkSession, d: str) -> DataFrame:
    return curate.candidates(frames.light_view(spark, d), CFG)


def _final(spark: SparkSession, d: str) -> DataFrame:
    return curate.curate(frames.light_view(spark, d), CFG, SIZE)


# Scans, filters, scores -------------------------------------------------------------------------------------------


@_query(_with(sql.light(), f"SELECT video_id, idx, {_rs('t_sec')} FROM light WHERE idx % 3 = 0"))
def stride_scan(spark, d):
    return scoring.timestamps(scoring.stride(frames.light_view(spark, d).select("video_id", "idx"), 3), 0).select("video_id", "idx", *_r("t_sec"))


@_query(_with(sql.light(), f"SELECT video_id, idx, {_rs('sharpness', 'contrast')} FROM light WHERE sharpness >= 80 AND contrast >= 20"))
def prefilter_light(spark, d):
    return scoring.prefilter(frames.light_view(spark, d), CFG).select("video_id", "idx", *_r("sharpness", "contrast"))


@_query(_with(*_PRE, f"SELECT video_id, idx, {_rs('quality')} FROM pre"))
def quality_score(spark, d):
    pre = scoring.prefilter(frames.light_view(spark, d), CFG)
    return pre.select("video_id", "idx", scoring.quality(CFG).alias("quality")).select("video_id", "idx", *_r("quality"))


@_query(_with(sql.light(), f"SELECT video_id, idx, round({sql.scale('sharpness', 80.0, 300.0)}, 6) AS s, round({sql.scale('contrast', 20.0, 80.0)}, 6) AS c FROM light"))
def scaled_metrics(spark, d):
    view = frames.light_view(spark, d)
    return view.select("video_id", "idx", F.round(scale(F.col("sharpness"), 80.0, 300.0), 6).alias("s"), F.round(scale(F.col("contrast"), 20.0, 80.0), 6).alias("c"))


@_query(_with(*_SCORED, f"SELECT video_id, idx, {_rs('quality', 'content_novelty', 'ml_score')} FROM scored"))
def novelty_fold(spark, d):
    return folds.score_frames(scoring.prefilter(frames.light_view(spark, d), CFG), CFG).select("video_id", "idx", *_r("quality", "content_novelty", "ml_score"))


@_query(_with(sql.light(True), sql.prefiltered(CFG), sql.scored(CFG), f"SELECT idx, {_rs('content_novelty', 'ml_score')} FROM scored"))
def novelty_fold_single(spark, d):
    return folds.score_frames(scoring.prefilter(frames.light_view(spark, d, True), CFG), CFG).select("idx", *_r("content_novelty", "ml_score"))


# Strata and targets -----------------------------------------------------------------------------------------------


@_query(_with(*_BINNED, "SELECT video_id, idx, altitude, view, cover, lighting FROM binned"))
def assign_strata(spark, d):
    return _pool(spark, d).select("video_id", "idx", *LABELS)


@_query(_with(*_BINNED, "SELECT altitude, view, cover, lighting, count(*) AS n FROM binned GROUP BY ALL"))
def strata_distribution(spark, d):
    return strata.strata_distribution(_pool(spark, d))


@_query(
    _with(
        *_BINNED,
        "marks AS (UNPIVOT (SELECT altitude, view, cover, lighting FROM binned) ON altitude, view, cover, lighting INTO NAME axis VALUE value)",
        "SELECT axis, value, count(*) AS n FROM marks GROUP BY ALL",
    )
)
def axes_summary(spark, d):
    return strata.axes_summary(_pool(spark, d))


#: Weights of each collection's own labels: how many of its frames bear them.
_COUNTED = """SELECT video_id, axis, value, count(*) AS weight FROM (SELECT video_id, 'cover' AS axis, CASE WHEN green_cover >= 0.5 THEN 'dense' ELSE 'sparse' END AS value FROM light
  UNION ALL SELECT video_id, 'lighting', CASE WHEN lighting_mean < 115 THEN 'dark' ELSE 'bright' END FROM light UNION ALL SELECT video_id, 'weather', 'fine' FROM light) GROUP BY ALL"""


def _counted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    view = frames.light_view(spark, d).select("video_id", "green_cover", "lighting_mean")
    pair = lambda axis, value: F.struct(F.lit(axis).alias("axis"), value.alias("value"))
    cover = F.when(F.col("green_cover") >= 0.5, "dense").otherwise("sparse")
    light = F.when(F.col("lighting_mean") < 115, "dark").otherwise("bright")
    marks = view.select("video_id", F.explode(F.array(pair("cover", cover), pair("lighting", light), pair("weather", F.lit("fine")))).alias("m"))
    return view, marks.groupBy("video_id", "m.axis", "m.value").agg(F.count("*").alias("weight"))


def _compiled(view: DataFrame, weights: DataFrame) -> DataFrame:
    return strata.compiled_targets(view, weights, CFG).select("video_id", "combo_ord", "combo_key", *LABELS, *_r("ratio"))


@_query(_with(sql.light(), sql.compiled(CFG, _COUNTED)))
def compile_targets(spark, d):
    """Targets of each collection from the weights that a table holds."""
    return _compiled(*_counted(spark, d))


@_query(_with(sql.light(), sql.compiled(CFG, f"SELECT * FROM ({_COUNTED}) WHERE value = 'sparse' AND weight % 2 = 0")))
def compile_targets_partial(spark, d):
    """Some collections have a weight for one label, others have none at all."""
    view, weights = _counted(spark, d)
    return _compiled(view, weights.where("value = 'sparse' AND weight % 2 = 0"))


@_query(_with(sql.light(), sql.compiled(CFG, f"SELECT * FROM ({_COUNTED}) WHERE axis = 'weather'")))
def compile_targets_uniform(spark, d):
    """Weights of unknown axes alone leave all shares equal."""
    view, weights = _counted(spark, d)
    return _compiled(view, weights.where("axis = 'weather'"))


@_query(_with(*_FINAL, sql.EVALUATED, "SELECT * FROM evaluated"))
def targets_evaluation(spark, d):
    out = strata.evaluate_targets(_final(spark, d), CFG)
    return out.withColumn("ratio", F.round("ratio", 6))


# Selection --------------------------------------------------------------------------------------------------------


@_query(_with(*_BINNED, sql.top_fraction(0.25), f"SELECT video_id, idx, rank, {_rs('ml_score')} FROM chosen"))
def topk_fraction(spark, d):
    return scoring.top_fraction(_pool(spark, d), 0.25).select("video_id", "idx", F.col("rank").cast("long").alias("rank"), *_r("ml_score"))


@_query(_with(*_BINNED, sql.stratified(CFG, SIZE), "SELECT video_id, idx, rank FROM strat"))
def stratified_select(spark, d):
    return select.stratified_select(_pool(spark, d), SIZE, CFG).select("video_id", "idx", F.col("rank").cast("long").alias("rank"))


@_query(_with(*_CHOSEN, "SELECT video_id, idx, phase, prelim_ord FROM chosen"))
def select_fill(spark, d):
    return select.preliminary(_pool(spark, d), SIZE, CFG).select("video_id", "idx", "phase", F.col("prelim_ord").cast("long").alias("prelim_ord"))


@_query(_with(*_FINAL, f"SELECT video_id, idx, phase, final_ord, {_rs('ml_score')} FROM final"))
def fill_after_duplicates(spark, d):
    return _final(spark, d).select("video_id", "idx", "phase", F.col("final_ord").cast("long").alias("final_ord"), *_r("ml_score"))


# Similarity -------------------------------------------------------------------------------------------------------

_VECTORS = f"nodes AS (SELECT 'v' AS video_id, vec_id + 1 AS ord, {sql.UNIT} AS unit FROM (SELECT vec_id, embedding::DOUBLE[] AS embed FROM embeddings))"


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/embeddings.parquet").select(F.lit("v").alias("video_id"), (F.col("vec_id") + 1).alias("ord"), F.col("embedding").alias("embed"))


@_query(_with(_VECTORS, "SELECT a.ord AS a, b.ord AS b, round(list_dot_product(a.unit, b.unit), 6) AS cos FROM nodes a JOIN nodes b ON a.ord < b.ord AND list_dot_product(a.unit, b.unit) > 0.30"))
def cosine_pairs(spark, d):
    return similarity.similar_pairs(_vectors(spark, d), 0.30).select("a", "b", *_r("cos"))


@_query(
    _with(
        sql.light(),
        f"n AS (SELECT video_id, idx, {sql.UNIT} AS unit, lead({sql.UNIT}) OVER (PARTITION BY video_id ORDER BY idx) AS nxt FROM light)",
        "SELECT video_id, idx, round(list_dot_product(unit, nxt), 6) AS cos FROM n WHERE nxt IS NOT NULL",
    )
)
def adjacent_cosine(spark, d):
    return similarity.neighbours(frames.light_view(spark, d), "idx").select("video_id", "idx", *_r("cos"))


@_query(_with(_VECTORS, sql.greedy("nodes", 0.35), "SELECT ord FROM kept"))
def greedy_keep(spark, d):
    return similarity.greedy_select(_vectors(spark, d), 0.35).select("ord")


@_query(
    _with(
        sql.light(),
        f"n AS (SELECT video_id, {sql.UNIT} AS unit, lead({sql.UNIT}) OVER (PARTITION BY video_id ORDER BY idx) AS nxt FROM light)",
        """q AS (SELECT video_id, count(*) AS n, quantile_cont(list_dot_product(unit, nxt)::FLOAT, 0.9) AS q FROM n GROUP BY ALL)
SELECT video_id, round(CASE WHEN n < 3 THEN 0.1::DOUBLE ELSE greatest(0.02::DOUBLE, least(0.95::DOUBLE, 1 - q)) END, 4) AS eps FROM q""",
    )
)
def auto_eps(spark, d):
    nodes = frames.light_view(spark, d).select("video_id", F.col("idx").alias("ord"), "embed")
    return similarity.auto_eps(nodes, high=0.95).select("video_id", F.round("eps", 4).alias("eps"))


@_query(_with(_VECTORS, sql.reach("nodes", 0.65), "SELECT ord, label FROM labels"))
def dbscan_components(spark, d):
    return similarity.dbscan(_vectors(spark, d), 0.65).select("ord", "label")


@_query(_with(_VECTORS, sql.reach("nodes", 0.65, 3), "SELECT ord, label FROM labels"))
def dbscan_core(spark, d):
    return similarity.dbscan(_vectors(spark, d), 0.65, 3).select("ord", "label")


_CLUSTERS = (*_BINNED, sql.top_fraction(0.5), sql.CLUSTER_NODES, sql.reach("nodes", CFG.eps), sql.CLUSTER_KEPT)


@_query(_with(*_CLUSTERS, "SELECT video_id, idx FROM kept JOIN nodes USING (video_id, ord)"))
def cluster_representative(spark, d):
    chosen = select.preliminary(_pool(spark, d), None, CFG.with_(selection_ratio=0.5))
    return curate.without_duplicates(chosen, CFG, "dbscan").select("video_id", "idx")


# Reports ----------------------------------------------------------------------------------------------------------


@_query(_with(*_FINAL, "SELECT count(*) AS n, round(avg(ml_score), 6) AS mean, round(quantile_cont(ml_score, 0.5), 6) AS median, round(min(ml_score), 6) AS low, round(max(ml_score), 6) AS high FROM final"))
def score_stats(spark, d):
    return curate.score_stats(_final(spark, d)).select("n", *_r("mean", "median", "low", "high"))


@_query(
    _with(
        *_FINAL,
        """a AS (SELECT video_id, count(*) AS candidates FROM binned GROUP BY ALL), b AS (SELECT video_id, count(*) AS selected FROM final GROUP BY ALL)
SELECT video_id, candidates, coalesce(selected, 0) AS selected, round(coalesce(selected, 0) / candidates::DOUBLE, 6) AS ratio FROM a LEFT JOIN b USING (video_id)""",
    )
)
def selection_ratio(spark, d):
    out = curate.selection_ratio(_pool(spark, d), _final(spark, d))
    return out.withColumn("ratio", F.round("ratio", 6))


@_query(_with(*_FINAL, sql.satisfaction(CFG, False), "SELECT * FROM satisfied"))
def satisfaction_report(spark, d):
    return strata.satisfaction(_final(spark, d), CFG, False)


@_query(_with(*_FINAL, sql.satisfaction(CFG, True), "SELECT * FROM satisfied"))
def satisfaction_web(spark, d):
    return strata.satisfaction(_final(spark, d), CFG, True)


@_query(_with(*_FINAL, "SELECT video_id, idx FROM final WHERE cover = 'sparse' OR lighting = 'dark'"))
def tile_filter(spark, d):
    return curate.tile_filter(_final(spark, d), ["cover:sparse", "lighting:dark"]).select("video_id", "idx")


@_query(
    _with(
        *_FINAL,
        "SELECT f.video_id, final_ord, f.idx, round(t_sec, 6) AS t_sec, round(f.ml_score, 6) AS ml_score, round(quality, 6) AS quality, round(content_novelty, 6) AS content_novelty, "
        f"{sql.KEY} AS strata FROM final f JOIN (SELECT video_id, idx, t_sec, quality, content_novelty FROM binned) b USING (video_id, idx)",
    )
)
def manifest_frames(spark, d):
    out = manifest.manifest_frames(_final(spark, d)).withColumnRenamed("source_index", "idx")
    pairs = F.concat_ws("|", *(F.concat(F.lit(f"{a}:"), F.col("strata")[i]) for i, a in enumerate(LABELS)))
    return out.select("video_id", F.col("final_ord").cast("long").alias("final_ord"), "idx", *_r("t_sec", "ml_score"), F.round("subscores.quality", 6).alias("quality"), F.round("subscores.content_novelty", 6).alias("content_novelty"), pairs.alias("strata"))


# End to end -------------------------------------------------------------------------------------------------------


@_query(_with(*_BINNED, sql.top_fraction(0.25), sql.NODES, sql.greedy("nodes", CFG.cosine_threshold), sql.LEFT_OVER, sql.refill(None), f"SELECT video_id, idx, final_ord, {_rs('ml_score')}, altitude, view, cover, lighting FROM final"))
def curate_topk(spark, d):
    out = curate.curate(frames.light_view(spark, d), CFG)
    return out.select("video_id", "idx", F.col("final_ord").cast("long").alias("final_ord"), *_r("ml_score"), *LABELS)


@_query(_with(*_FINAL, f"SELECT video_id, idx, final_ord, {_rs('ml_score')}, altitude, view, cover, lighting FROM final"))
def curate_stratified(spark, d):
    return _final(spark, d).select("video_id", "idx", F.col("final_ord").cast("long").alias("final_ord"), *_r("ml_score"), *LABELS)


_DENSITY = (*_CHOSEN, sql.CLUSTER_NODES, sql.reach("nodes", CFG.eps), sql.CLUSTER_KEPT, sql.LEFT_OVER, sql.refill(SIZE))


@_query(_with(*_DENSITY, f"SELECT video_id, idx, final_ord, {_rs('ml_score')} FROM final"))
def curate_dbscan(spark, d):
    out = curate.curate(frames.light_view(spark, d), CFG, SIZE, "dbscan")
    return out.select("video_id", "idx", F.col("final_ord").cast("long").alias("final_ord"), *_r("ml_score"))


# Images -----------------------------------------------------------------------------------------------------------

_IMAGE = (sql.PIXELS, sql.STENCIL)


def _image(spark: SparkSession, d: str) -> DataFrame:
    return image.features(image.metrics(frames.image_view(spark, d)), IMAGE).drop("pixels")


_METRICS = "met AS (SELECT video_id, idx, var_pop(lap) AS sharpness, stddev_pop(l) AS contrast FROM stencil GROUP BY ALL)"


@_query(_with(*_IMAGE, _METRICS, f"SELECT video_id, idx, {_rs('sharpness', 'contrast')} FROM met WHERE sharpness >= 19500.5 AND contrast >= 31.01"))
def prefilter_image(spark, d):
    return scoring.prefilter(image.metrics(frames.image_view(spark, d)), IMAGE_CFG).select("video_id", "idx", *_r("sharpness", "contrast"))


_EXPOSURE = "e AS (SELECT video_id, idx, avg(l) AS mean, count(*) FILTER (l < 10) / (64 + 1e-9::DOUBLE) AS under, count(*) FILTER (l >= 246) / (64 + 1e-9::DOUBLE) AS over FROM px GROUP BY ALL)"


@_query(_with(sql.PIXELS, _EXPOSURE, f"SELECT video_id, idx, {_rs('mean', 'under', 'over')} FROM e"))
def exposure_metrics(spark, d):
    return _image(spark, d).select("video_id", "idx", *_r("mean", "under", "over"))


@_query(
    _with(
        sql.PIXELS,
        _EXPOSURE,
        "SELECT video_id, idx, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - least(1.0::DOUBLE, 0.6::DOUBLE * abs(mean - 128) / 128 + 0.4::DOUBLE * 2 * (under + over)))), 6) AS exposure_score FROM e",
    )
)
def exposure_score(spark, d):
    m = _image(spark, d)
    return m.select("video_id", "idx", scoring.exposure_score(F.col("mean"), F.col("under"), F.col("over")).alias("exposure_score")).select("video_id", "idx", *_r("exposure_score"))


@_query(
    _with(
        *_IMAGE,
        "SELECT video_id, idx, round(greatest(0.0::DOUBLE, 1 - least(1.0::DOUBLE, stddev_pop(l - blur) / 60)), 6) AS noise_score, round(avg(abs(l - blur)), 6) AS hf_energy FROM stencil GROUP BY ALL",
    )
)
def noise_and_energy(spark, d):
    return _image(spark, d).select("video_id", "idx", *_r("noise_score", "hf_energy"))


_OCTANTS = """oct AS (SELECT video_id, idx, sqrt(gx * gx + gy * gy) AS m, CASE WHEN gy >= 0 AND gx > gy THEN 0 WHEN gy > 0 AND gx > 0 THEN 1 WHEN gx <= 0 AND gy > -gx THEN 2
  WHEN gx < 0 AND gy > 0 THEN 3 WHEN gy <= 0 AND gx < gy THEN 4 WHEN gy < 0 AND gx < 0 THEN 5 WHEN gx >= 0 AND gy < -gx THEN 6 WHEN gx = 0 AND gy = 0 THEN 0 ELSE 7 END AS bin FROM stencil),
bins AS (SELECT v.video_id, v.idx, b.bin, coalesce(h, 0) AS h FROM (SELECT DISTINCT video_id, idx FROM stencil) v CROSS JOIN (SELECT unnest(range(8)) AS bin) b
  LEFT JOIN (SELECT idx, bin, sum(m) AS h FROM oct GROUP BY ALL) s ON s.idx = v.idx AND s.bin = b.bin),
shares AS (SELECT video_id, idx, h / (sum(h) OVER (PARTITION BY idx) + 1e-9::DOUBLE) AS p FROM bins)"""


@_query(_with(*_IMAGE, _OCTANTS, "SELECT video_id, idx, round(-sum(p * ln(p + 1e-9::DOUBLE)), 6) AS view_entropy FROM shares GROUP BY ALL"))
def view_entropy(spark, d):
    return _image(spark, d).select("video_id", "idx", *_r("view_entropy"))


_SECTORS = """turns AS (SELECT video_id, idx, n, CASE WHEN gx = 0 AND gy = 0 THEN 0 ELSE floor((CASE WHEN gy < 0 THEN 2 * pi() ELSE 0 END + atan2(gy, gx)) * n / (2 * pi()) + 1e-9::DOUBLE) END % n AS bin,
  sqrt(gx * gx + gy * gy) AS m FROM stencil, (VALUES (4), (6), (12)) b(n)),
sums AS (SELECT video_id, idx, n, bin, sum(m) AS h FROM turns GROUP BY ALL),
shares AS (SELECT video_id, idx, n, h / (sum(h) OVER (PARTITION BY idx, n) + 1e-9::DOUBLE) AS p FROM sums)"""


@_query(_with(*_IMAGE, _SECTORS, "SELECT video_id, idx, n AS bins, round(-sum(p * ln(p + 1e-9::DOUBLE)), 6) AS view_entropy FROM shares GROUP BY ALL"))
def view_entropy_bins(spark, d):
    """Directions in four, six and twelve sectors."""
    view = frames.image_view(spark, d)
    every = [image.features(view, replace(IMAGE, view_bins=n)).select("video_id", "idx", F.lit(n).alias("bins"), *_r("view_entropy")) for n in (4, 6, 12)]
    return every[0].unionByName(every[1]).unionByName(every[2])


_DIM = replace(IMAGE, center=100.0, center_weight=0.5, clip_weight=0.7, clip_multiplier=1.5, under_below=30, over_from=200)


@_query(
    _with(
        sql.PIXELS,
        "e AS (SELECT video_id, idx, avg(l) AS mean, count(*) FILTER (l < 30) / (64 + 1e-9::DOUBLE) AS under, count(*) FILTER (l >= 200) / (64 + 1e-9::DOUBLE) AS over FROM px GROUP BY ALL)",
        "SELECT video_id, idx, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - least(1.0::DOUBLE, 0.5::DOUBLE * abs(mean - 100) / 100 + 0.7::DOUBLE * 1.5::DOUBLE * (under + over)))), 6) AS exposure_score FROM e",
    )
)
def exposure_settings(spark, d):
    """The exposure score by other weights, centre and ends, as settings may name them."""
    return image.features(frames.image_view(spark, d), _DIM).select("video_id", "idx", *_r("exposure_score"))


@_query(
    _with(
        sql.PIXELS,
        "g0 AS (SELECT video_id, idx, 2 * (g + 1e-6::DOUBLE) - (r + 1e-6::DOUBLE) - (b + 1e-6::DOUBLE) AS e FROM px)",
        "g1 AS (SELECT *, min(e) OVER (PARTITION BY idx) AS lo, max(e) OVER (PARTITION BY idx) AS hi FROM g0)",
        "SELECT video_id, idx, round(avg(((e - lo) / (hi - lo + 1e-9::DOUBLE) >= 0.6::DOUBLE)::INT), 6) AS green_cover FROM g1 GROUP BY ALL",
    )
)
def green_cover(spark, d):
    return _image(spark, d).select("video_id", "idx", *_r("green_cover"))


@_query(_with(sql.PIXELS, "SELECT video_id, idx, round(avg(l), 6) AS lighting_mean FROM px GROUP BY ALL"))
def lighting_mean(spark, d):
    return _image(spark, d).select("video_id", "idx", *_r("lighting_mean"))


_HSV = """c0 AS (SELECT video_id, idx, b, g, r, greatest(b, g, r)::DOUBLE AS v, greatest(b, g, r)::DOUBLE - least(b, g, r) AS d FROM px),
c1 AS (SELECT *, CASE WHEN d = 0 THEN 0 WHEN v = r THEN 60 * (g - b) / d WHEN v = g THEN 120 + 60 * (b - r) / d ELSE 240 + 60 * (r - g) / d END AS h0 FROM c0),
c2 AS (SELECT video_id, idx, floor((CASE WHEN h0 < 0 THEN h0 + 360 ELSE h0 END) / 2 + 0.5::DOUBLE) % 180 AS h, CASE WHEN v = 0 THEN 0 ELSE floor(255 * d / v + 0.5::DOUBLE) END AS s, v FROM c1),
c3 AS (SELECT video_id, idx, unnest([least(15, floor(h * 16 / 180)), 16 + least(15, floor(s * 16 / 256)), 32 + least(15, floor(v * 16 / 256))])::INT AS bin FROM c2),
c4 AS (SELECT video_id, idx, bin, count(*)::DOUBLE AS n FROM c3 GROUP BY ALL),
hist AS (SELECT video_id, idx, bin, n / (sqrt(sum(n * n) OVER (PARTITION BY idx)) + 1e-9::DOUBLE) AS x FROM c4)"""
_LOW = """cells AS (SELECT video_id, idx, (y // 2) * 4 + x // 2 AS cell, floor(avg(b) + 0.5::DOUBLE)::BIGINT AS b, floor(avg(g) + 0.5::DOUBLE)::BIGINT AS g, floor(avg(r) + 0.5::DOUBLE)::BIGINT AS r FROM px GROUP BY ALL),
grays AS (SELECT video_id, idx, cell, ((9798 * r + 19235 * g + 3735 * b + 16384) // 32768)::DOUBLE AS l FROM cells),
mids AS (SELECT *, l - avg(l) OVER (PARTITION BY idx) AS c FROM grays),
low AS (SELECT video_id, idx, cell AS bin, c / (sqrt(sum(c * c) OVER (PARTITION BY idx)) + 1e-9::DOUBLE) AS x FROM mids)"""


def _unrolled(m: DataFrame, lo: int, hi: int) -> DataFrame:
    """(video_id, idx, bin, x) of the entries of a part of the embedding, scaled to unit length."""
    part = F.slice("embed", lo + 1, hi - lo)
    return m.select("video_id", "idx", F.posexplode(normalised(part)).alias("bin", "x"))


@_query(_with(sql.PIXELS, _HSV, "SELECT video_id, idx, bin, round(x, 4) AS x FROM hist"))
def hsv_hist(spark, d):
    return _unrolled(_image(spark, d), 0, 48).where("x > 0").select("video_id", "idx", "bin", F.round("x", 4).alias("x"))


@_query(_with(sql.PIXELS, _LOW, "SELECT video_id, idx, bin::INT AS bin, round(x, 4) + 0.0 AS x FROM low"))
def lowres_embed(spark, d):
    return _unrolled(_image(spark, d), 48, 64).select("video_id", "idx", "bin", (F.round("x", 4) + F.lit(0.0)).alias("x"))


@_query(
    _with(
        sql.PIXELS,
        _HSV,
        _LOW,
        "both_parts AS (SELECT video_id, idx, bin, x FROM hist UNION ALL SELECT video_id, idx, 48 + bin, x FROM low)",
        "SELECT video_id, idx, bin::INT AS bin, round(x / (sqrt(sum(x * x) OVER (PARTITION BY idx)) + 1e-9::DOUBLE), 4) + 0.0 AS x FROM both_parts",
    )
)
def combined_embed(spark, d):
    m = _image(spark, d).select("video_id", "idx", F.posexplode("embed").alias("bin", "x"))
    return m.where("bin >= 48 OR x <> 0").select("video_id", "idx", "bin", (F.round(F.col("x").cast("double"), 4) + F.lit(0.0)).alias("x"))


@_query(None)
def curate_images(spark, d):
    """All stages from pixels on; its stages have their SQL one by one above, tests hold the whole against a plain version."""
    pre = scoring.prefilter(image.metrics(frames.image_view(spark, d)), IMAGE_CFG)
    out = curate.curate(image.features(pre, IMAGE).drop("pixels"), IMAGE_CFG, SIZE)
    return out.select("video_id", "idx", F.col("final_ord").cast("long").alias("final_ord"), *_r("ml_score"), *LABELS)


# Sources, sinks, runs ---------------------------------------------------------------------------------------------

_SUMS = "sums AS (SELECT video_id, idx, sum(b)::BIGINT AS b, sum(g)::BIGINT AS g, sum(r)::BIGINT AS r FROM px GROUP BY ALL)"


def _channel_sums(raw: DataFrame) -> DataFrame:
    """The image view's sums of each channel, from the pixels' bytes."""
    octets = F.expr("transform(sequence(1, length(pixels)), i -> cast(conv(substr(hex(pixels), 2 * i - 1, 2), 16, 10) AS BIGINT))")
    sums = [F.expr(f"aggregate(filter(px, (x, i) -> i % 3 = {k}), 0L, (s, x) -> s + x)").alias(c) for k, c in enumerate("bgr")]
    return raw.withColumn("px", octets).select("video_id", "idx", "t_sec", "height", "width", *sums)


def _scanned(spark: SparkSession, paths: list[str], fps: float | None = None) -> DataFrame:
    """Every second frame of videos, read in small parts."""
    spark.dataSource.register(frames.VideoSource)
    reader = spark.read.format("raw_video").option("paths", ",".join(paths)).option("stride", 2).option("partition_bytes", 4096)
    got = (reader.option("fps", fps) if fps else reader).load()
    out = _channel_sums(got.withColumn("video_id", F.regexp_extract("video_id", r"([^/]+)\.[a-z0-9]+$", 1)))
    return out.withColumn("t_sec", F.round("t_sec", 6))


@_query(
    _with(
        sql.PIXELS,
        _SUMS,
        "placed AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY idx) - 1 AS n FROM sums)",
        "SELECT video_id, n AS idx, round(n / 25.0::DOUBLE, 6) AS t_sec, 8 AS height, 8 AS width, b, g, r FROM placed WHERE n % 2 = 0",
    )
)
def ppm_scan(spark, d):
    """Videos written as files of images, then read back frame by frame with a stride."""
    listed = frames.write_videos(frames.image_view(spark, d), scratch(spark, "ppm"))
    paths = [r["path"] for r in listed.select("path").collect()]  # a path for each video, as a run names its inputs
    return _scanned(spark, paths, 25)


def _written(spark: SparkSession, d: str, kind: str) -> list[str]:
    """Paths of the image view's videos, a file for each."""
    listed = frames.write_videos(frames.image_view(spark, d), scratch(spark, kind), kind, 25)
    return [r["path"] for r in listed.select("path").collect()]


@_query(
    _with(
        sql.PIXELS,
        _SUMS,
        "placed AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY idx) - 1 AS n FROM sums)",
        "SELECT video_id, n AS idx, round(n / 25.0::DOUBLE, 6) AS t_sec, 8 AS height, 8 AS width, b, g, r FROM placed WHERE n % 2 = 0",
    )
)
def avi_scan(spark, d):
    """The same from AVI files, by their tables of frames; the rate of frames is the files' own."""
    return _scanned(spark, _written(spark, d, "avi"))


@_query(
    _with(
        sql.PIXELS,
        "sums AS (SELECT video_id, idx, sum(l)::BIGINT AS l FROM px GROUP BY ALL)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY idx) - 1 AS n FROM sums)",
        "SELECT video_id, n AS idx, round(n / 25.0::DOUBLE, 6) AS t_sec, 8 AS height, 8 AS width, l AS b, l AS g, l AS r FROM placed WHERE n % 2 = 0",
    )
)
def y4m_scan(spark, d):
    """The same in grey from Y4M files."""
    return _scanned(spark, _written(spark, d, "y4m"))


@_query(
    _with(
        sql.light(),
        "best AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY sharpness DESC, idx) AS n, count(*) OVER (PARTITION BY video_id) AS c FROM light)",
        "SELECT video_id, idx, printf('frame_%06d_src%06d_t%010.3f.jpg', n - 1, idx, t_sec) AS name FROM best WHERE n <= greatest(1, floor(c * 0.1::DOUBLE))",
    )
)
def image_sink(spark, d):
    best = scoring.top_fraction(frames.light_view(spark, d), 0.1, "sharpness").withColumn("final_ord", F.col("rank"))
    saved = curate.write_frames(materialise(best, "best"), frames.image_view(spark, d), scratch(spark, "saved"))
    return saved.select("video_id", "idx", F.regexp_extract("path", "[^/]+$", 0).alias("name"))


@_query(
    _with(
        *_FINAL,
        "SELECT f.video_id, f.final_ord, f.idx, round(t_sec, 6) AS t_sec, round(f.ml_score, 6) AS ml_score, round(sharpness, 6) AS sharpness, round(lighting_mean, 6) AS lighting_mean, "
        "f.altitude || '/' || f.view || '/' || f.cover || '/' || f.lighting AS strata, (SELECT count(*) FROM final) AS selected, (SELECT count(*) FROM binned) AS candidates, 61.5::DOUBLE AS elapsed "
        "FROM final f JOIN (SELECT video_id, idx, t_sec, sharpness, lighting_mean FROM binned) b USING (video_id, idx)",
    )
)
def manifest_read_back(spark, d):
    """A run's manifest, written and read again."""
    pool = _pool(spark, d)
    path = scratch(spark, "manifest")
    manifest.write_manifest(materialise(curate.select_from(pool, CFG, SIZE), "final"), pool, CFG, path, config.resolve({"target_size": SIZE}, {}), 61.5, "v.ppm")
    head, rows = manifest.read_manifest(spark, path)
    summary = head["task_summary"]
    numbers = [F.lit(int(summary["selected_count"])).cast("long").alias("selected"), F.lit(int(summary["candidates_count"])).cast("long").alias("candidates"), F.lit(float(summary["elapsed_time_sec"])).alias("elapsed")]
    return rows.select("video_id", "final_ord", F.col("source_index").alias("idx"), *_r("t_sec", "ml_score", "sharpness", "lighting_mean"), F.concat_ws("/", "strata").alias("strata"), *numbers)


@_query(
    _with(
        *_FINAL,
        "SELECT f.video_id, f.final_ord, f.idx, round(f.ml_score, 6) AS ml_score, round(content_novelty, 6) AS content_novelty, f.altitude || '/' || f.view || '/' || f.cover || '/' || f.lighting AS strata, "
        "(SELECT count(*) FROM final) AS selected FROM final f JOIN (SELECT video_id, idx, content_novelty FROM binned) b USING (video_id, idx)",
    )
)
def manifest_document(spark, d):
    """A run's manifest as one JSON document, read again as any reader would."""
    pool = _pool(spark, d)
    path = scratch(spark, "manifest")
    manifest.write_manifest(materialise(curate.select_from(pool, CFG, SIZE), "final"), pool, CFG, path, config.resolve({}, {}), 1.0, "v.ppm")
    manifest.write_document(spark, path, f"{path}.json")
    kind = "frames array<struct<video_id: string, final_ord: long, source_index: long, ml_score: double, subscores: struct<content_novelty: double>, strata: array<string>>>, task_summary struct<selected_count: long>"
    rows = spark.read.schema(kind).option("multiLine", True).json(f"{path}.json").select(F.explode("frames").alias("f"), "task_summary.selected_count")
    columns = [F.col("f.source_index").alias("idx"), F.round("f.ml_score", 6).alias("ml_score"), F.round("f.subscores.content_novelty", 6).alias("content_novelty")]
    return rows.select("f.video_id", "f.final_ord", *columns, F.concat_ws("/", "f.strata").alias("strata"), F.col("selected_count").alias("selected"))


@_query(
    _with(
        *_FINAL,
        """a AS (SELECT video_id, count(*) AS candidates_count FROM binned GROUP BY ALL),
b AS (SELECT video_id, count(*) AS selected_count, avg(ml_score) AS average, quantile_cont(ml_score, 0.5) AS median, min(ml_score) AS low, max(ml_score) AS high FROM final GROUP BY ALL)
SELECT video_id, candidates_count, coalesce(selected_count, 0) AS selected_count, round(coalesce(selected_count, 0) / candidates_count::DOUBLE, 6) AS selection_ratio, """
        + _rs("average", "median", "low", "high")
        + " FROM a LEFT JOIN b USING (video_id)",
    )
)
def manifest_summary(spark, d):
    out = manifest.summaries(_final(spark, d), _pool(spark, d))
    return out.select("video_id", "candidates_count", "selected_count", *_r("selection_ratio", "average", "median", "low", "high"))


@_query(_with(*_FINAL, sql.EVALUATED, "SELECT * FROM result"))
def targets_result(spark, d):
    return strata.targets_result(strata.evaluate_targets(_final(spark, d), CFG), _pool(spark, d))


@_query(
    _with(
        *_FINAL,
        sql.EVALUATED,
        f"remedies(remedy) AS (VALUES {', '.join('(' + repr(r) + ')' for r in manifest.REMEDIES)})",
        "SELECT video_id, reason, remedy FROM (SELECT video_id, 'size' AS reason FROM result WHERE selected_count < 14 UNION ALL SELECT video_id, 'targets' FROM result WHERE NOT success), remedies",
    )
)
def report_advice(spark, d):
    return manifest.advice(_final(spark, d), _pool(spark, d), CFG, 14)


@_query(_with(*_FINAL, sql.satisfaction(CFG, False), "SELECT axis, value, format('{:<10} {:<10} {:8.1f} {:8.1f} {:>10}', axis, value, 100 * actual, 100 * target, CASE WHEN satisfied THEN 'yes' ELSE 'no' END) AS line FROM satisfied"))
def report_table(spark, d):
    return manifest.strata_lines(strata.satisfaction(_final(spark, d), CFG, False))


@_query(_with(sql.light(), "SELECT count(*) AS seen, count(*) FILTER (sharpness >= 80 AND contrast >= 20) AS kept, count(*) FILTER (NOT (sharpness >= 80 AND contrast >= 20)) AS filtered FROM light"))
def prefilter_counters(spark, d):
    return scoring.prefilter_counts(frames.light_view(spark, d), CFG)


#: Of each customer's run: parameters that were given, and those of the settings file.
_ASKED = {
    "stride": ("CAST(c_custkey % 3 AS STRING)", "CAST(c_nationkey % 4 AS STRING)"),
    "min_sharpness": ("CASE WHEN c_custkey % 2 = 0 THEN '95.5' END", "CASE WHEN c_nationkey % 2 = 0 THEN '0.0' ELSE '70.0' END"),
    "target_size": ("CASE WHEN c_custkey % 5 < 3 THEN CAST(c_custkey % 5 AS STRING) END", "CASE WHEN c_nationkey % 3 = 0 THEN '12' END"),
    "dedup_method": ("CASE WHEN c_custkey % 7 = 0 THEN 'dbscan' WHEN c_custkey % 7 = 1 THEN '' END", "CASE WHEN c_nationkey % 5 = 0 THEN 'dbscan' END"),
    "colour": ("'red'", "'blue'"),
}
_VIA = "CASE WHEN c_custkey % 4 = 0 THEN 'web' ELSE 'cli' END"
_PRESETS = ", ".join(f"('{n}', {'NULL' if v is None else repr(str(v))})" for n, v in config.RUN_DEFAULTS.items())
_ROWS = " UNION ALL ".join(f"SELECT c_custkey AS run_id, {_VIA} AS via, '{n}' AS name, {g} AS given, {c} AS configured FROM customer" for n, (g, c) in _ASKED.items())


@_query(
    f"""WITH asked AS ({_ROWS}), presets(name, preset) AS (VALUES {_PRESETS}),
every_one AS (SELECT run_id, presets.name, preset, via, given, configured FROM (SELECT DISTINCT c_custkey AS run_id FROM customer) CROSS JOIN presets LEFT JOIN asked USING (run_id, name)),
marked AS (SELECT *, coalesce(given, '') NOT IN ('', '0', '0.0') OR name = 'target_size' AND coalesce(given, '') <> '' AS g, coalesce(configured, '') NOT IN ('', '0', '0.0') OR name = 'target_size' AND coalesce(configured, '') <> '' AS c FROM every_one)
SELECT run_id, name, CASE WHEN g THEN given WHEN c THEN configured ELSE preset END AS value, CASE WHEN g THEN via WHEN c THEN 'config' ELSE 'default' END AS source FROM marked"""
)
def run_parameters(spark, d):
    """Arguments against a settings file, for a run of each customer: the effective values and where they came from."""
    customers = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_nationkey")
    each = F.array(*(F.struct(F.lit(n).alias("name"), F.expr(g).alias("given"), F.expr(c).alias("configured")) for n, (g, c) in _ASKED.items()))
    asked = customers.select(F.col("c_custkey").alias("run_id"), F.expr(_VIA).alias("via"), F.explode(each).alias("a")).select("run_id", "via", "a.*")
    return runs.parameters(asked)


@_query("SELECT s_suppkey AS run_id, CASE WHEN s_suppkey % 3 = 2 THEN 'data/output/.' || s_suppkey ELSE 'data/output/' || s_name || CASE WHEN s_suppkey % 3 = 1 THEN '.raw' ELSE '' END END AS folder FROM supplier")
def output_folders(spark, d):
    """The folders of runs that name none, after their sources."""
    key = F.col("s_suppkey")
    name = F.when(key % 3 == 2, F.concat(F.lit("."), key.cast("string"))).when(key % 3 == 1, F.concat("s_name", F.lit(".raw.ppm"))).otherwise(F.concat("s_name", F.lit(".avi/")))
    return spark.read.parquet(f"{d}/supplier.parquet").select(key.alias("run_id"), runs.output_folder(F.concat(F.lit("hdfs://v/x.y/"), name)).alias("folder"))


@_query(
    _with(
        sql.light(),
        "best AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY sharpness DESC, idx) AS n, count(*) OVER (PARTITION BY video_id) AS c FROM light)",
        "SELECT video_id, idx, CASE idx % 3 WHEN 0 THEN 'images/' || idx || '.jpg' ELSE '' END AS link FROM best WHERE n <= greatest(1, floor(c * 0.1::DOUBLE))",
    )
)
def image_links(spark, d):
    """Links of saved images below the folder that is served; others are empty."""
    best = scoring.top_fraction(frames.light_view(spark, d), 0.1, "sharpness").select("video_id", "idx")
    folder = F.element_at(F.array(F.lit("/run/a/images/"), F.lit("/run/ab/images/"), F.lit("/run/a/../b/")), (F.col("idx") % 3 + 1).cast("int"))
    return best.select("video_id", "idx", runs.link(F.concat(folder, F.col("idx").cast("string"), F.lit(".jpg")), F.lit("/run/a/")).alias("link"))


@_query(_with(sql.light(), "SELECT count(*) AS frames, false AS written FROM light WHERE sharpness >= 1e9"))
def empty_run(spark, d):
    """No candidate passes: an empty selection, and no manifest."""
    cfg = CFG.with_(min_sharpness=1e9)
    pool = curate.candidates(frames.light_view(spark, d), cfg)
    final = curate.select_from(pool, cfg, SIZE)
    path = scratch(spark, "nothing")
    written = manifest.write_manifest(final, pool, cfg, path, {}) is not None or manifest.read_manifest(spark, path)[0] is not None
    return final.agg(F.count("*").alias("frames")).select("frames", F.lit(written).alias("written"))


@_query(_with(*_SCORED, f"SELECT video_id, idx, {_rs('quality', 'content_novelty', 'ml_score')} FROM scored"))
def novelty_stream(spark, d):
    """The novelty fold over a stream of files, to a table."""
    view = frames.light_view(spark, d)
    feed, out = scratch(spark, "feed"), scratch(spark, "stream")
    view.write.parquet(feed)
    scored = score_stream(spark.readStream.schema(view.schema).parquet(feed), CFG)
    scored.writeStream.format("parquet").option("checkpointLocation", scratch(spark, "offsets")).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(scored.schema).parquet(out).select("video_id", "idx", *_r("quality", "content_novelty", "ml_score"))


@_query(_with(*_SCORED, f"SELECT video_id, idx, {_rs('quality', 'content_novelty', 'ml_score')} FROM scored"))
def novelty_late_stream(spark, d):
    """The same fold over files that hold the frames in no order: the watermark releases them in theirs."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    view = frames.light_view(spark, d).withColumn("seen_at", F.timestamp_seconds(F.col("idx").cast("double")))
    feed, out = scratch(spark, "feed"), scratch(spark, "stream")
    view.repartition(3, F.xxhash64("idx")).write.parquet(feed)
    for k in (1, 2):  # a frame of no collection ends the stream: its time lets the watermark pass all others
        last = view.agg(F.max("seen_at").alias("last")).select((F.col("last") + F.expr(f"INTERVAL '{k}' DAY * 3000")).alias("seen_at"))
        mark = view.limit(1).drop("seen_at").withColumn("video_id", F.lit(None).cast("string")).withColumn("sharpness", F.lit(CFG.min_sharpness)).withColumn("contrast", F.lit(CFG.min_contrast))
        mark.crossJoin(F.broadcast(last)).select(view.columns).coalesce(1).write.mode("append").parquet(feed)  # one row each
    stream = own.readStream.schema(view.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    scored = score_late_stream(stream, CFG, delay="1000 days")
    scored.writeStream.format("parquet").option("checkpointLocation", scratch(spark, "offsets")).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(scored.schema).parquet(out).where("video_id IS NOT NULL").select("video_id", "idx", *_r("quality", "content_novelty", "ml_score"))


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
