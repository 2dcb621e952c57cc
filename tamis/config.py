"""Settings of a curation run, their precedence and their provenance.

The run parameter for the way duplicates are removed is ``dedup_method``: as given, else ``defaults.dedup_method``, else
``deduplication.method`` of the settings file, else greedy."""

from __future__ import annotations

import dataclasses
import json
import logging
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from tamis.functions.image import ImageSettings

log = logging.getLogger(__name__)

#: Axes of the strata with their labels, in order.
AXES: dict[str, tuple[str, str]] = {
    "altitude": ("low", "high"),
    "view": ("nadir", "oblique"),
    "cover": ("dense", "sparse"),
    "lighting": ("bright", "dark"),
}
#: Defaults that a run uses where neither caller nor file sets a parameter (or sets it to zero).
RUN_DEFAULTS = {"stride": 1, "min_sharpness": 80.0, "min_contrast": 20.0, "novelty_threshold": 0.3, "target_size": None, "dedup_method": "greedy"}


@dataclass(frozen=True)
class Config:
    """Typed settings with the code's defaults."""

    axes: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(AXES))
    targets: dict[str, dict[str, float]] | None = None
    limits: dict[str, float] | None = None
    quality_weight: float = 0.5
    novelty_weight: float = 0.5
    components: tuple[float, float, float, float] = (0.35, 0.30, 0.25, 0.10)
    sharpness_range: tuple[float, float] = (80.0, 300.0)
    contrast_range: tuple[float, float] = (20.0, 80.0)
    novelty_memory: int = 64
    novelty_threshold: float = 0.3
    view_entropy: float = 1.8
    cover_ratio: float = 0.5
    lighting_mean: float = 115.0
    altitude_quantile: float = 0.5
    high_quality: float = 0.95
    selection_ratio: float = 0.25
    cosine_threshold: float = 0.85
    duplicates_method: str = "greedy"
    eps: float | None = None
    #: Quantile of the neighbours' cosines, least and largest automatic radius, and the radius of fewer than three frames.
    eps_bounds: tuple[float, float, float, float] = (0.9, 0.02, 0.30, 0.10)
    min_samples: int = 1
    min_sharpness: float = 80.0
    min_contrast: float = 20.0
    fallback_fps: float = 30.0
    image: ImageSettings = field(default_factory=ImageSettings)
    image_suffix: str = "jpg"
    jpeg_quality: int = 95
    #: Frames between two lines of progress in the log.
    log_interval: int = 1000

    @property
    def sparse_cap(self) -> float:
        """0.30 without any limits; 1.0 where limits are given but not this one."""
        return 0.30 if self.limits is None else float(self.limits.get("sparse_max_ratio", 1.0))

    def with_(self, **changes: Any) -> Config:
        return dataclasses.replace(self, **changes)


def load_settings(path: str | Path) -> dict:
    """A YAML (where a parser is installed) or JSON file; a missing or broken file gives {} and is logged."""
    try:
        text = Path(path).read_text(encoding="utf-8")
        try:
            import yaml
        except ImportError:
            return dict(json.loads(text))
        return yaml.safe_load(text) or {}
    except Exception as error:  # any parser's error
        log.error("settings %s: %s", path, error)
        return {}


def from_settings(raw: dict) -> Config:
    """A Config from a nested settings document; absent keys keep the code's defaults."""

    def at(path: str, default: Any) -> Any:
        node: Any = raw
        for key in path.split("."):
            if not isinstance(node, dict) or key not in node:
                return default
            node = node[key]
        return node

    base, shown = Config(), ImageSettings()
    bounds = at("constants.dbscan_eps_bounds", base.eps_bounds[1:3])
    image = ImageSettings(
        noise_scale=float(at("image_processing.noise_scaling_factor", shown.noise_scale)),
        under_below=int(at("image_processing.exposure.underexposure_bins", shown.under_below)),
        over_from=int(at("image_processing.exposure.overexposure_start", shown.over_from)),
        green_threshold=float(at("proxies.green_cover_threshold", shown.green_threshold)),
        hsv_bins=tuple(at("embedding.hsv_bins", shown.hsv_bins)),
        lowres=tuple(at("embedding.lowres_size", shown.lowres)),
        view_bins=int(at("proxies.view_entropy_bins", shown.view_bins)),
        center=float(at("image_processing.exposure.center_value", shown.center)),
        center_weight=float(at("image_processing.exposure.center_penalty_weight", shown.center_weight)),
        clip_weight=float(at("image_processing.exposure.clip_penalty_weight", shown.clip_weight)),
        clip_multiplier=float(at("image_processing.exposure.clip_multiplier", shown.clip_multiplier)),
    )
    parts = ("sharpness", "contrast", "exposure", "noise")
    return Config(
        axes={k: tuple(v) for k, v in at("stratification.axes", base.axes).items()},
        targets=at("stratification.targets_axes", None),
        limits=at("stratification.limits", None),
        quality_weight=at("scoring.weights.quality", 0.5),
        novelty_weight=at("scoring.weights.content_novelty", 0.5),
        components=tuple(at(f"scoring.quality_components.{p}", d) for p, d in zip(parts, base.components, strict=True)),
        sharpness_range=tuple(at("scoring.scale_ranges.sharpness", base.sharpness_range)),
        contrast_range=tuple(at("scoring.scale_ranges.contrast", base.contrast_range)),
        novelty_memory=at("scoring.novelty_memory", 64),
        novelty_threshold=at("defaults.novelty_threshold", 0.3) or 0.3,
        view_entropy=at("stratification.thresholds.view_entropy", 1.8),
        cover_ratio=at("stratification.thresholds.cover_ratio", 0.5),
        lighting_mean=at("stratification.thresholds.lighting_mean", 115.0),
        altitude_quantile=at("stratification.thresholds.altitude_quantile", 0.5),
        high_quality=at("selection.high_quality_threshold", 0.95),
        selection_ratio=at("selection.threshold_selection_ratio", 0.25),
        cosine_threshold=at("deduplication.cosine_threshold", 0.85),
        duplicates_method=str(at("deduplication.method", "greedy") or "greedy").lower(),
        eps=at("deduplication.eps", None),
        min_samples=at("deduplication.min_samples", 1) or 1,
        min_sharpness=at("defaults.min_sharpness", 80.0) or 80.0,
        min_contrast=at("defaults.min_contrast", 20.0) or 20.0,
        fallback_fps=at("constants.fallback_fps", 30.0),
        eps_bounds=(float(at("constants.dbscan_auto_eps_quantile", base.eps_bounds[0])), float(bounds[0]), float(bounds[1]), base.eps_bounds[3]),
        image=image,
        jpeg_quality=int(at("output.jpeg_quality", base.jpeg_quality)),
        log_interval=int(at("output.log_intervals.frames_processed", base.log_interval)),
    )


def resolve(given: dict[str, Any], settings: dict, via: str = "cli", source: str | None = None, out: str | None = None) -> dict[str, dict[str, Any]]:
    """Each run parameter's effective value and where it came from: ``via`` ("cli", or "web" for a service), config or
    default. Zero and empty values fall through to the default, as in a run. With the run's ``source`` also the source
    and the output folder, which is "derived" where neither caller nor file names one."""
    defaults = dict(settings.get("defaults") or {})
    defaults["dedup_method"] = defaults.get("dedup_method") or (settings.get("deduplication") or {}).get("method")
    found_out = {}
    if source is not None:
        folder = out or defaults.get("out")
        found_out["video"] = {"value": source, "source": via}
        found_out["out"] = {"value": folder or output_folder(source), "source": via if out else "config" if folder else "derived"}
    result = dict(found_out)
    for name, default in RUN_DEFAULTS.items():
        for source, found in ((via, given.get(name)), ("config", defaults.get(name))):
            if found or (name == "target_size" and found is not None):
                result[name] = {"value": found, "source": source}
                break
        else:
            result[name] = {"value": default, "source": "default"}
    return result


def output_folder(source: str, given: str | None = None) -> str:
    """The folder of a run: as given, else named after the source without its extension."""
    return given or str(Path("data/output") / Path(source).stem)


def with_run(cfg: Config, params: dict[str, dict[str, Any]]) -> Config:
    """``cfg`` with a run's resolved parameters."""
    names = {"min_sharpness": "min_sharpness", "min_contrast": "min_contrast", "novelty_threshold": "novelty_threshold", "dedup_method": "duplicates_method"}
    return cfg.with_(**{own: params[n]["value"] for n, own in names.items() if n in params})
