"""Settings of a file reach the run, by the names that they have there."""

import json

import numpy as np
import pytest

from tamis import cli, config
from tamis.functions import image
from tamis.sources import frames


@pytest.mark.parametrize(
    "given, settings, value, source",
    [
        ({}, {"deduplication": {"method": "dbscan"}}, "dbscan", "config"),
        ({}, {"defaults": {"dedup_method": "dbscan"}, "deduplication": {"method": "greedy"}}, "dbscan", "config"),
        ({"dedup_method": "greedy"}, {"deduplication": {"method": "dbscan"}}, "greedy", "cli"),
        ({}, {"defaults": {"scoring_method": "dbscan"}}, "greedy", "default"),
        ({}, {}, "greedy", "default"),
    ],
)
def test_the_way_duplicates_are_removed(given, settings, value, source):
    got = config.resolve(given, settings)
    assert got["dedup_method"] == {"value": value, "source": source}
    assert config.with_run(config.from_settings(settings), got).duplicates_method == value


def test_image_settings_and_bounds():
    raw = {
        "embedding": {"hsv_bins": [8, 4, 2], "lowres_size": [6, 3]},
        "proxies": {"view_entropy_bins": 6, "green_cover_threshold": 0.4},
        "image_processing": {"noise_scaling_factor": 9, "exposure": {"center_value": 100, "underexposure_bins": 5, "overexposure_start": 250, "center_penalty_weight": 0.1, "clip_penalty_weight": 0.2, "clip_multiplier": 3}},
        "constants": {"dbscan_auto_eps_quantile": 0.5, "dbscan_eps_bounds": [0.1, 0.6]},
        "output": {"jpeg_quality": 60, "log_intervals": {"frames_processed": 7}},
    }
    cfg = config.from_settings(raw)
    assert cfg.image == image.ImageSettings(9.0, 5, 250, 0.4, (8, 4, 2), (6, 3), 6, 100.0, 0.1, 0.2, 3.0)
    assert cfg.eps_bounds == (0.5, 0.1, 0.6, 0.10) and cfg.jpeg_quality == 60 and cfg.log_interval == 7
    plain = config.from_settings({})
    assert plain.image == image.ImageSettings() and plain.eps_bounds == config.Config().eps_bounds


def test_a_run_uses_them(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(9)
    every = [rng.integers(0, 256, (16, 16, 3), dtype=np.uint8) for _ in range(12)]
    video = tmp_path / "field.ppm"
    video.write_bytes(b"".join(map(frames.encode_ppm, every)))
    settings = tmp_path / "s.json"
    raw = {
        "defaults": {"min_sharpness": 1.0, "min_contrast": 1.0},
        "deduplication": {"method": "dbscan"},
        "embedding": {"lowres_size": [4, 4]},
        "proxies": {"view_entropy_bins": 5},
        "image_processing": {"noise_scaling_factor": 90.0, "exposure": {"center_value": 90.0}},
        "output": {"jpeg_quality": 30},
    }
    settings.write_text(json.dumps(raw))
    monkeypatch.chdir(tmp_path)
    assert cli.main([f"file://{video}", "--config", str(settings), "-o", str(tmp_path / "out")], spark) == 0
    one = json.loads((tmp_path / "out/manifest.json").read_text())
    assert one["run_params"]["dedup_method"] == {"value": "dbscan", "source": "config"} and one["frames"]
    for f in one["frames"]:
        img = every[f["source_index"]]
        g = image.gray(img)
        rest = g - image.blur(g)
        assert f["noise_score"] == pytest.approx(max(0.0, 1 - min(1.0, float(rest.std()) / 90.0)))
        assert f["view_entropy"] == pytest.approx(image.view_entropy(g, 5))
        assert f["exposure_score"] == pytest.approx(image.exposure_score(*image.exposure(g, image.ImageSettings()), image.ImageSettings(center=90.0)))


def test_local_output_is_for_local_mode():
    class Far:
        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(ValueError):
        cli.output_address(Far, "out")
    assert cli.output_address(Far, "hdfs://a/out/") == "hdfs://a/out"


def test_parameters_of_many_runs_without_joins(spark):
    """Odd rows as a join of every run with every name gives them, from one aggregation of numbers."""
    from tamis.config import RUN_DEFAULTS
    from tamis.plans import runs

    rows = [("r", "cli", "stride", "3", None), ("r", "web", "stride", "0", "2"), ("r", "cli", "colour", "red", None), ("r", "cli", None, "1", None)]
    rows += [(None, "cli", "stride", "9", None), ("s", "cli", "target_size", "0", "5"), ("t", "cli", "colour", "red", None)]
    asked = spark.createDataFrame(rows, "run_id string, via string, name string, given string, configured string")
    got = runs.parameters(asked)
    preset = {n: None if v is None else str(v) for n, v in RUN_DEFAULTS.items()}
    want = [(run, n, v, "default") for run in ("r", "s", "t", None) for n, v in preset.items() if (run, n) not in {("r", "stride"), ("s", "target_size")}]
    want += [("r", "stride", "3", "cli"), ("r", "stride", "2", "config"), ("s", "target_size", "0", "cli")]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan
