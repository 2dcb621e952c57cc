import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis import cli, config
from tamis.config import Config
from tamis.functions import image
from tamis.operators import folds, quantile, scoring, select, similarity, strata
from tamis.plans import curate, manifest
from tamis.sources import frames

FRAME = "video_id string, idx long, t_sec double, embed array<double>, sharpness double, contrast double, exposure_score double, noise_score double, hf_energy double, view_entropy double, green_cover double, lighting_mean double"
SCORED = "video_id string, idx long, ml_score double, embed array<double>, altitude string, view string, cover string, lighting string"


def frame(idx, embed=(1.0, 0.0), sharpness=150.0, contrast=50.0, hf=10.0, entropy=2.0, green=0.7, light=120.0):
    return ("v", idx, idx / 30, list(map(float, embed)), sharpness, contrast, 0.8, 0.9, float(hf), float(entropy), float(green), float(light))


def test_quality_golden(spark):
    df = spark.createDataFrame([frame(0)], FRAME)
    got = folds.score_frames(df, Config()).first()
    assert abs(got["quality"] - 0.5513636) < 1e-6 and got["content_novelty"] == 1.0 and abs(got["ml_score"] - 0.7756818) < 1e-6


def test_exposure_golden(spark):
    assert abs(image.exposure_score(128, 0.1, 0.1) - 0.84) < 1e-12
    row = spark.range(1).select(scoring.exposure_score(F.lit(128.0), F.lit(0.1), F.lit(0.1)).alias("x")).first()
    assert abs(row["x"] - 0.84) < 1e-12


def test_prefilter_keeps_minimum_and_rejects_nan(spark):
    rows = [frame(0, sharpness=80.0, contrast=20.0), frame(1, sharpness=79.9), frame(2, sharpness=float("nan"))]
    assert [r["idx"] for r in scoring.prefilter(spark.createDataFrame(rows, FRAME), Config()).collect()] == [0]


def test_single_frame_quantile_is_a_float(spark):
    row = strata.assign_strata(spark.createDataFrame([frame(0, hf=0.6)], FRAME), Config()).first()
    assert (row["altitude"], row["view"], row["cover"], row["lighting"]) == ("high", "nadir", "dense", "bright")


def test_two_frames_strata(spark):
    rows = [frame(0, hf=10, entropy=1.0, green=0.2, light=100), frame(1, hf=30, entropy=2.0, green=0.8, light=200)]
    got = {r["idx"]: (r["altitude"], r["view"], r["cover"], r["lighting"]) for r in strata.assign_strata(spark.createDataFrame(rows, FRAME), Config()).collect()}
    assert got == {0: ("high", "oblique", "sparse", "dark"), 1: ("low", "nadir", "dense", "bright")}


def novelties(spark, embeds, memory, threshold=0.3):
    df = spark.createDataFrame([frame(i, e) for i, e in enumerate(embeds)], FRAME)
    got = folds.score_frames(df, Config(novelty_memory=memory, novelty_threshold=threshold)).orderBy("idx").collect()
    return [round(r["content_novelty"], 6) for r in got]


def test_novelty_memory(spark):
    a, b = (1, 0), (0, 1)
    assert novelties(spark, [a, b, a], 1) == [1, 1, 1]
    assert novelties(spark, [a, b, a], 2) == [1, 1, 0]
    assert novelties(spark, [a, b, a], 0) == [1, 1, 0]


def test_target_shares():
    shares = strata.axis_shares(Config(targets={"cover": {"dense": 0.6, "odd": 9.0}}))
    assert abs(shares["cover"]["dense"] - 0.375) < 1e-9 and abs(shares["cover"]["sparse"] - 0.625) < 1e-9
    assert len(strata.combinations(Config())) == 16


def scored(rows):
    return [("v", i, s, list(map(float, e)), *labels) for i, s, e, labels in rows]


def test_largest_remainder(spark):
    from tamis.catalog import CFG

    rows = scored([(i, 0.5, (1, 0), ("low", "nadir", "dense", "bright")) for i in range(10)])
    got = strata.evaluate_targets(spark.createDataFrame(rows, SCORED), CFG).collect()
    want = {r["combo_key"]: r["expected"] for r in got}
    assert sum(want.values()) == 10
    assert sum(v for k, v in want.items() if "cover:dense" in k) == 8
    assert {k for k, v in want.items() if v and "sparse" in k} == {"altitude:low|view:nadir|cover:sparse|lighting:bright", "altitude:low|view:oblique|cover:sparse|lighting:bright"}


def test_fill_brings_twins_back(spark):
    """One stratum, the two best frames alike: the fill adds the twin again after it was removed."""
    label = ("low", "nadir", "dense", "bright")
    pool = spark.createDataFrame(scored([(0, 0.9, (1, 0), label), (1, 0.8, (1, 0), label), (2, 0.7, (0, 1), label)]), SCORED)
    cfg = Config(cosine_threshold=0.99)
    chosen = select.preliminary(pool, 2, cfg)
    assert sorted((r["idx"], r["phase"]) for r in chosen.collect()) == [(0, 0), (1, 1)]
    kept = curate.without_duplicates(chosen, cfg)
    assert [r["idx"] for r in kept.collect()] == [0]
    final = select.final_order(kept, scoring.ranked(pool), 2)
    assert sorted(r["idx"] for r in final.collect()) == [0, 1]
    assert select.final_order(kept, scoring.ranked(pool), 0).count() == 0


def test_sparse_cap(spark):
    label = ("low", "nadir", "sparse", "bright")
    pool = spark.createDataFrame(scored([(i, 0.99 - i / 100, (1, 0), label) for i in range(5)]), SCORED)
    assert select.stratified_select(pool, 4, Config()).count() == 1
    assert select.preliminary(pool, 4, Config()).count() == 4


def test_top_fraction_ties_and_least(spark):
    label = ("low", "nadir", "dense", "bright")
    pool = spark.createDataFrame(scored([(2, 0.5, (1, 0), label), (1, 0.5, (1, 0), label), (0, 0.4, (1, 0), label)]), SCORED)
    assert [r["idx"] for r in scoring.top_fraction(pool, 0.25).collect()] == [1]


def test_greedy_and_clusters(spark):
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(300, 6))
    rows[5] = rows[2]
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    nodes = spark.createDataFrame([("v", i + 1, r.tolist()) for i, r in enumerate(rows)], "video_id string, ord long, embed array<double>")
    kept = []
    for i in range(300):
        if all(unit[i] @ unit[j] <= 0.7 for j in kept):
            kept.append(i)
    assert sorted(r["ord"] - 1 for r in similarity.greedy_keep(nodes, 0.7).collect()) == kept
    near = unit @ unit.T >= 1 - 0.15 - 1e-12
    core = [i for i in range(300) if near[i].sum() >= 4]
    label, seen = dict.fromkeys(range(300), -1), set()
    for i in core:
        if i in seen:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x in seen:
                continue
            seen.add(x)
            label[x] = i + 1
            todo += [j for j in core if near[x, j] and j not in seen]
    for i in range(300):
        if i not in seen:
            label[i] = min((label[j] for j in core if near[i, j]), default=-1)
    got = {r["ord"] - 1: r["label"] for r in similarity.dbscan(nodes, 0.15, 4).collect()}
    assert got == label


def test_blocks_meet(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 7)
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(40, 4))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    nodes = spark.createDataFrame([("v", i + 1, r.tolist()) for i, r in enumerate(unit)], "video_id string, ord long, embed array<double>")
    want = {(i + 1, j + 1) for i in range(40) for j in range(i + 1, 40) if unit[i] @ unit[j] > 0.5}
    got = [(r["a"], r["b"]) for r in similarity.similar_pairs(nodes, 0.5).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_cells_lose_no_pair(spark, monkeypatch):
    """Tight clusters, strangers, opposite, zero and tiny vectors, over many cells and collections."""
    monkeypatch.setattr(similarity, "BLOCK", 5)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    rows = [centres[k % 12] + 0.2 * rng.normal(size=8) for k in range(110)] + [-centres[0], np.zeros(8), np.full(8, 1e-9), centres[0], centres[0]]
    nodes = [(f"v{k % 2}", k // 2 + 1, np.asarray(r).tolist()) for k, r in enumerate(rows)]
    df = spark.createDataFrame(nodes, "video_id string, ord long, embed array<double>")
    unit = {(v, o): np.array(r) / (np.linalg.norm(r) + 1e-9) for v, o, r in nodes}
    for threshold in (0.95, 0.5, -0.2):
        want = {(v, a, b) for v, a in unit for w, b in unit if v == w and a < b and unit[v, a] @ unit[v, b] > threshold}
        got = [(r["video_id"], r["a"], r["b"]) for r in similarity.similar_pairs(df, threshold).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert similarity.similar_pairs(df.where("false"), 0.5).count() == 0


def test_long_chains(spark, monkeypatch):
    """Each frame like the next one alone, over several runs of ranks, and a star across them."""
    n = 5000
    edges = [("v", i, i + 1, 1.0) for i in range(1, n)] + [("w", 1, i, 1.0) for i in range(2, 3000)]
    monkeypatch.setattr(similarity, "similar_pairs", lambda *a, **k: spark.createDataFrame(edges, "video_id string, a long, b long, cos double"))
    nodes = spark.createDataFrame([("v", i, [1.0]) for i in range(1, n + 1)] + [("w", i, [1.0]) for i in range(1, 3001)], "video_id string, ord long, embed array<double>")
    got = {(r["video_id"], r["ord"]) for r in similarity.greedy_keep(nodes, 0.5, ranks=2000).collect()}
    assert got == {("v", i) for i in range(1, n + 1, 2)} | {("w", 1), ("w", 3000)}
    labels = similarity.components(spark.createDataFrame(edges, "video_id string, a long, b long, cos double"), nodes)
    assert {tuple(r) for r in labels.groupBy("video_id", "root").count().collect()} == {("v", 1, n), ("w", 1, 2999), ("w", 3000, 1)}


def test_quantiles_by_rank(spark):
    rng = np.random.default_rng(6)
    rows = [(f"k{k}", float(x)) for k, n in enumerate((1, 2, 3, 50, 400)) for x in np.round(rng.normal(size=n), 1)] + [("hot", 1.0)] * 500 + [("hot", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r["k"]: r["m"] for r in quantile.exact_quantile(df, "k", "x", q, "m").collect()}
        want = {k: np.quantile([x for a, x in rows if a == k], q) for k in {a for a, x in rows if x is not None}}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_noise_is_one_cluster(spark):
    rows = [("v", i + 1, v, 0.5 + i / 10) for i, v in enumerate(np.eye(4).tolist())]
    nodes = spark.createDataFrame(rows, "video_id string, ord long, embed array<double>, ml_score double")
    labels = similarity.dbscan(nodes, 0.1, 3)
    best = similarity.representatives(labels.join(nodes, ["video_id", "ord"])).collect()
    assert [(r["ord"], r["label"]) for r in best] == [(4, -1)]


def test_auto_eps(spark):
    def eps(vectors):
        nodes = spark.createDataFrame([("v", i, v) for i, v in enumerate(vectors)], "video_id string, ord long, embed array<double>")
        return round(similarity.auto_eps(nodes).first()["eps"], 6)

    assert eps([[1.0, 0.0], [0.0, 1.0]]) == 0.1
    assert eps([[1.0, 0.0]] * 5) == 0.02
    assert eps([[1.0, 0.0], [0.0, 1.0]] * 3) == 0.3


def test_image_kernels_against_loops():
    rng = np.random.default_rng(2)
    img = rng.integers(0, 256, (9, 11))

    def at(y, x):
        y, x = (-v if v < 0 else 2 * (n - 1) - v if v >= n else v for v, n in ((y, 9), (x, 11)))
        return int(img[y, x])

    lap, soft = np.zeros((9, 11)), np.zeros((9, 11))
    for y in range(9):
        for x in range(11):
            lap[y, x] = at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * at(y, x)
            soft[y, x] = (sum((2 - abs(a)) * (2 - abs(b)) * at(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)) + 8) // 16
    assert (image.laplacian(img) == lap).all() and (image.blur(img) == soft).all()
    flat = np.full((8, 8, 3), 77, np.uint8)
    assert image.green_cover(flat, 0.6) == 0.0
    assert not image.low_resolution(flat, (4, 4)).any()
    assert len(image.embedding(rng.integers(0, 256, (72, 128, 3)).astype(np.uint8), image.ImageSettings())) == 2352
    gx, gy = np.meshgrid(np.arange(-3, 4), np.arange(-3, 4))
    angle = np.arctan2(gy, gx) % (2 * np.pi)
    want = np.where((gx == 0) & (gy == 0), 0, np.floor(np.round(angle / (np.pi / 4), 9)) % 8)
    assert (image.sector(gx, gy) == want).all()


def test_settings(tmp_path):
    path = tmp_path / "run.json"
    path.write_text(json.dumps({"defaults": {"stride": 2}, "scoring": {"novelty_memory": 32}, "stratification": {"limits": {"other": 1}}}))
    raw = config.load_settings(path)
    assert raw["defaults"]["stride"] == 2 and config.load_settings(tmp_path / "none") == {}
    (tmp_path / "broken").write_text("key: value: another")
    assert config.load_settings(tmp_path / "broken") == {}
    cfg = config.from_settings(raw)
    assert cfg.novelty_memory == 32 and cfg.sparse_cap == 1.0 and Config().sparse_cap == 0.30
    got = config.resolve({"stride": 0, "min_contrast": 5.0}, raw)
    assert got["stride"] == {"value": 2, "source": "config"} and got["min_contrast"]["source"] == "cli" and got["min_sharpness"] == {"value": 80.0, "source": "default"}


def test_ppm_source_and_writer(spark, tmp_path):
    rng = np.random.default_rng(3)
    images = [rng.integers(0, 256, (5, 6, 3)).astype(np.uint8) for _ in range(5)]
    path = tmp_path / "a.ppms"
    path.write_bytes(b"".join(map(frames.encode_ppm, images)) + b"P6 9 9 255\nxx")
    spark.dataSource.register(frames.VideoSource)
    got = spark.read.format("raw_video").option("paths", str(path)).option("stride", "2").option("fps", "10").load()
    rows = got.orderBy("idx").collect()
    assert [(r["idx"], r["t_sec"]) for r in rows] == [(0, 0.0), (2, 0.2), (4, 0.4)]
    assert bytes(rows[1]["pixels"]) == images[2].tobytes()
    chosen = got.where("idx > 0").selectExpr("video_id", "idx", "t_sec", "row_number() over (order by idx) as final_ord").withColumn("video_id", F.lit("a"))
    listed = curate.write_frames(chosen, got.withColumn("video_id", F.lit("a")), f"file://{tmp_path}/out", "ppm").collect()
    assert {r["path"].rsplit("/", 1)[1] for r in listed} == {"frame_000000_src000002_t000000.200.ppm", "frame_000001_src000004_t000000.400.ppm"}
    read = frames.image_files(spark, f"{tmp_path}/out/part-*/a").orderBy("idx").collect()
    assert sorted(bytes(r["pixels"]) for r in read) == sorted([images[2].tobytes(), images[4].tobytes()])


def test_manifest_round_trip(spark, sf_dir, tmp_path):
    from tamis.catalog import CFG

    pool = curate.candidates(frames.light_view(spark, sf_dir), CFG)
    final = curate.materialise(curate.select_from(pool, CFG, 5), "final")
    path = f"file://{tmp_path}/m"
    head = manifest.write_manifest(final, pool, CFG, path, config.resolve({}, {}, "web", "/in/a.ppm"), 61.0, "/in/a.ppm")
    again, rows = manifest.read_manifest(spark, path)
    assert again == json.loads(json.dumps(head)) and rows.count() == 50
    assert head["run_params"]["video"]["source"] == "web" and head["run_params"]["out"] == {"value": "data/output/a", "source": "derived"}
    assert manifest.write_document(spark, path, f"file://{tmp_path}/one.json")
    one = json.loads((tmp_path / "one.json").read_text())
    assert set(one) == {"input_video", "run_params", "task_summary", "frames", "targets_evaluation"} and len(one["frames"]) == 50
    assert one["task_summary"]["video"] == "a.ppm" and one["task_summary"]["selected_count"] == 50 and " - " in one["task_summary"]["ml_score"]["range"]
    assert {"saved_path", "source_index", "t_sec", "ml_score", "subscores", "strata", *manifest.METRICS} <= set(one["frames"][0])
    result = one["targets_evaluation"]
    assert sum(result["expected_counts"].values()) == result["total_expected"] == 50 and result["success"] == (result["total_shortfall"] == 0)
    assert manifest.evaluation(final, pool, None) == {"success": True, "reason": "no_config"}
    assert manifest.evaluation(final, pool, CFG.with_(axes={})) == {"success": True, "reason": "no_axes_defined"}
    text = manifest.report(head, CFG, 1000)
    for part in ("took 1 min 1 s", "50 frames instead of 1000.", "## What to try", "target", "raise the cosine threshold", "## Strata"):
        assert part in text
    assert manifest.write_manifest(final.where("false"), pool, CFG, f"file://{tmp_path}/n", {}) is None
    assert manifest.read_manifest(spark, f"file://{tmp_path}/n") == (None, None) and not manifest.write_document(spark, f"file://{tmp_path}/n", f"file://{tmp_path}/x")


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    rng = np.random.default_rng(9)
    video = tmp_path / "field.ppm"
    video.write_bytes(b"".join(frames.encode_ppm(rng.integers(0, 256, (16, 16, 3), dtype=np.uint8)) for _ in range(12)))
    settings = tmp_path / "s.json"
    settings.write_text(json.dumps({"defaults": {"stride": 2, "min_sharpness": 1.0, "min_contrast": 1.0, "dedup_method": "greedy"}, "embedding": {}}))
    monkeypatch.chdir(tmp_path)
    run = [f"file://{video}", "--config", str(settings), "--target-size", "3", "-o", str(tmp_path / "out")]
    assert cli.main(run, spark) == 0
    said = capsys.readouterr().out
    assert "3 of 6 candidates kept" in said and "min_sharpness" in said
    one = json.loads((tmp_path / "out/manifest.json").read_text())
    assert one["run_params"]["stride"] == {"value": 2, "source": "config"} and one["run_params"]["target_size"] == {"value": 3, "source": "cli"}
    assert len(list((tmp_path / "out/images").rglob("frame_*.jpg"))) == 3 and all(f["saved_path"].endswith(".jpg") for f in one["frames"])
    assert "from 6 frames kept 6" in (tmp_path / "out/curation.log").read_text()
    monkeypatch.setattr("sys.stdin", io.StringIO())
    assert cli.main(run, spark) == 1
    assert cli.main([*run, "--overwrite", "--stride", "4"], spark) == 0
    assert json.loads((tmp_path / "out/manifest.json").read_text())["task_summary"]["candidates_count"] == 3


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    from tamis.catalog import CFG
    from tamis.streaming.novelty import score_stream

    view = frames.light_view(spark, sf_dir)
    for k in range(2):
        view.where(F.col("idx") % 500 >= 250 if k else F.col("idx") % 500 < 250).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(view.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = score_stream(stream, CFG).writeStream.format("memory").queryName("scored").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    got = {r["idx"]: round(r["ml_score"], 9) for r in spark.table("scored").collect()}
    batch = folds.score_frames(scoring.prefilter(view, CFG), CFG)
    assert got == {r["idx"]: round(r["ml_score"], 9) for r in batch.collect()}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("tags,want", [([], 0), (["cover:dense"], 1), (["cover:sparse", "view:nadir"], 1), (["cover:sparse"], 0)])
def test_tile_filter(spark, tags, want):
    rows = scored([(0, 0.5, (1, 0), ("low", "nadir", "dense", "bright"))])
    assert curate.tile_filter(spark.createDataFrame(rows, SCORED), tags).count() == want
