"""The manifest of a run, and its report.

A manifest is a folder: ``header`` holds one JSON document of aggregates, ``frames`` a JSON line for each frame, written by
the executors. ``write_document`` streams both into a single JSON file for readers that expect one; the driver holds one
partition of frames at a time.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.config import Config
from tamis.operators import strata
from tamis.operators.quantile import exact_quantile
from tamis.plans.curate import score_stats

log = logging.getLogger(__name__)

AXES = ("altitude", "view", "cover", "lighting")
METRICS = ("sharpness", "contrast", "exposure_score", "noise_score", "hf_energy", "view_entropy", "green_cover", "lighting_mean")
_KIND = "video_id string, final_ord long, saved_path string, source_index long, t_sec double, ml_score double, subscores struct<quality: double, content_novelty: double>, strata array<string>, " + ", ".join(f"{m} double" for m in METRICS)
#: What a report advises.
REMEDIES = (
    "More candidates: lower --min-sharpness or --min-contrast.",
    "More frames to choose from: lower --stride.",
    "More frames that count as new: lower --novelty-threshold.",
    "Fewer frames taken for duplicates: raise the cosine threshold.",
)


def manifest_frames(selected: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """A row for each selected frame, with the path of its image where ``saved(video_id, idx, path)`` lists it."""
    rows = selected if saved is None else selected.join(saved.select("video_id", "idx", F.col("path").alias("saved_path")), ["video_id", "idx"], "left")
    path = F.lit(None).cast("string").alias("saved_path") if saved is None else F.col("saved_path")
    return rows.select(
        "video_id",
        F.col("final_ord").cast("long").alias("final_ord"),
        path,
        F.col("idx").alias("source_index"),
        "t_sec",
        "ml_score",
        F.struct("quality", "content_novelty").alias("subscores"),
        F.array(*AXES).alias("strata"),
        *METRICS,
    )


def summaries(selected: DataFrame, pool: DataFrame) -> DataFrame:
    """For each collection: candidates, selected frames, their ratio, and the mean, median, least and largest score."""
    s = F.col("ml_score")
    made = selected.groupBy("video_id").agg(F.count("*").alias("selected_count"), F.avg(s).alias("average"), F.min(s).alias("low"), F.max(s).alias("high"))
    middle = exact_quantile(selected, "video_id", "ml_score", 0.5, "median")
    seen = pool.groupBy("video_id").agg(F.count("*").alias("candidates_count"))
    out = seen.join(made, "video_id", "left").join(middle, "video_id", "left")
    count = F.coalesce("selected_count", F.lit(0))
    return out.select("video_id", "candidates_count", count.alias("selected_count"), (count / F.col("candidates_count")).alias("selection_ratio"), "average", "median", "low", "high")


def evaluation(selected: DataFrame, pool: DataFrame, cfg: Config | None) -> dict:
    """The targets of all collections together, as a document; at most the product of the axes' sizes is collected."""
    if cfg is None:
        return {"success": True, "reason": "no_config"}
    if not cfg.axes:
        return {"success": True, "reason": "no_axes_defined"}
    sums = [F.sum(c).alias(c) for c in ("expected", "actual", "shortfall")]
    rows = {r["combo_key"]: r for r in strata.evaluate_targets(selected, cfg).groupBy("combo_key").agg(*sums).collect()}
    keys = [k for k, _, _ in strata.combinations(cfg)]
    got = {c: {k: rows[k][c] if k in rows else 0 for k in keys} for c in ("expected", "actual", "shortfall")}
    total = {c: sum(v.values()) for c, v in got.items()}
    return {
        "success": total["shortfall"] == 0,
        "selected_count": total["actual"],
        "candidates_count": pool.count(),
        "per_axis_weights": strata.axis_shares(cfg),
        "combo_ratios": {k: s for k, _, s in strata.combinations(cfg)},
        "expected_counts": got["expected"],
        "actual_counts": got["actual"],
        "shortfalls": {k: n for k, n in got["shortfall"].items() if n},
        "total_expected": total["expected"],
        "total_actual": total["actual"],
        "total_shortfall": total["shortfall"],
    }


def header(selected: DataFrame, pool: DataFrame, cfg: Config | None, run_params: dict, source: str = "", out: str = "", elapsed: float | None = None) -> dict | None:
    """A manifest without its frames; None without frames."""
    stats = score_stats(selected).first()
    if not stats["n"]:
        return None
    total = pool.count()
    axes: dict[str, dict[str, int]] = {a: {} for a in AXES}
    for r in strata.axes_summary(selected).collect():  # axes x labels
        axes[r["axis"]][r["value"]] = r["n"]
    combos = selected.groupBy(strata.combo_key().alias("k")).count().collect()  # at most the product of the axes' sizes
    return {
        "input_video": source,
        "run_params": run_params,
        "task_summary": {
            "video": source.rstrip("/").rsplit("/", 1)[-1],
            "output_dir": out,
            "candidates_count": total,
            "selected_count": stats["n"],
            "elapsed_time_sec": elapsed,
            "selection_ratio": f"{100 * stats['n'] / total:.1f}%" if total else "N/A",
            "ml_score": {"average": f"{stats['mean']:.3f}", "median": f"{stats['median']:.3f}", "range": f"{stats['low']:.3f} - {stats['high']:.3f}"},
            "axes_summary": axes,
            "strata_distribution": {r["k"]: r["count"] for r in combos},
        },
        "targets_evaluation": evaluation(selected, pool, cfg),
    }


def write_manifest(selected: DataFrame, pool: DataFrame, cfg: Config | None, path: str, run_params: dict, elapsed: float | None = None, source: str = "", saved: DataFrame | None = None) -> dict | None:
    """Writes the folder ``path`` and returns the header; nothing, and a warning, without frames. The folder must be new."""
    got = header(selected, pool, cfg, run_params, source, path, elapsed)
    if got is None:
        log.warning("no frames: no manifest written")
        return None
    manifest_frames(selected, saved).write.mode("errorifexists").json(f"{path}/frames")
    selected.sparkSession.createDataFrame([(json.dumps(got, indent=2, ensure_ascii=False),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/header")
    return got


def read_manifest(spark, path: str) -> tuple[dict | None, DataFrame | None]:
    """(header, frames); (None, None), logged, where it cannot be read."""
    try:
        found = json.loads("\n".join(r["value"] for r in spark.read.text(f"{path}/header", wholetext=True).collect()))
        return found, spark.read.schema(_KIND).json(f"{path}/frames")
    except Exception as error:
        log.error("manifest %s: %s", path, error)
        return None, None


def write_document(spark, path: str, to: str) -> bool:
    """The manifest of the folder ``path`` as one JSON file at the address ``to``, frames in their order."""
    from pyarrow import fs

    found, frames = read_manifest(spark, path)
    if found is None:
        return False
    system, at = fs.FileSystem.from_uri(to)
    evaluated = found.pop("targets_evaluation")
    with system.open_output_stream(at) as out:
        out.write(json.dumps(found, indent=2, ensure_ascii=False)[:-2].encode() + b',\n  "frames": [')
        first = True
        for r in frames.orderBy("video_id", "final_ord").toLocalIterator():
            out.write((b"\n    " if first else b",\n    ") + json.dumps(r.asDict(True), ensure_ascii=False).encode())
            first = False
        out.write(b'\n  ],\n  "targets_evaluation": ' + json.dumps(evaluated, indent=2, ensure_ascii=False).replace("\n", "\n  ").encode() + b"\n}\n")
    return True


def advice(selected: DataFrame, pool: DataFrame, cfg: Config, size: int | None) -> DataFrame:
    """(video_id, reason, remedy) of the collections that are short of ``size`` ("size") or miss targets ("targets")."""
    result = strata.targets_result(strata.evaluate_targets(selected, cfg), pool)
    short = F.lit(size is not None) & (F.col("selected_count") < F.lit(size or 0))
    reasons = F.array_compact(F.array(F.when(short, F.lit("size")), F.when(~F.col("success"), F.lit("targets"))))
    remedies = F.explode(F.array(*map(F.lit, REMEDIES)))
    return result.select("video_id", F.explode(reasons).alias("reason")).select("video_id", "reason", remedies.alias("remedy"))


def strata_lines(satisfied: DataFrame) -> DataFrame:
    """The rows of ``strata.satisfaction`` as lines of the report's table."""
    percent = [(100 * F.col(c)) for c in ("actual", "target")]
    return satisfied.select("axis", "value", F.format_string("%-10s %-10s %8.1f %8.1f %10s", "axis", "value", *percent, F.when(F.col("satisfied"), "yes").otherwise("no")).alias("line"))


def report(found: dict, cfg: Config | None, target_size: int | None = None) -> str:
    """A manifest's header as text: the run, its parameters, scores, the table of strata, whether targets are met, and what
    to change where they or the size are not."""
    summary = found["task_summary"]
    n, params = summary["selected_count"], found["run_params"]
    out = [f"# Curation of {summary['video'] or '(no name)'}", ""]
    out += [f"{n} of {summary['candidates_count']} candidates kept ({summary['selection_ratio']}), in {summary['output_dir'] or '(no folder)'}"]
    seconds = summary.get("elapsed_time_sec")
    if seconds is not None:
        out.append("took {} min {} s".format(*divmod(int(seconds), 60)))
    wide = max(map(len, params), default=0)
    out += ["", "## Parameters", "", *(f"{k:<{wide}} = {v['value']} [{v['source']}]" for k, v in params.items())]
    if not n:
        return "\n".join([*out, "", "The manifest has no frames."])
    score = summary["ml_score"]
    out += ["", "## Scores", "", f"mean {score['average']}, median {score['median']}, from {score['range'].replace(' - ', ' to ')}"]
    out += ["", "## Strata", "", f"{'axis':<10} {'value':<10} {'actual %':>8} {'target %':>8} {'met':>10}"]
    met = True
    for axis, values in (cfg.axes if cfg else summary["axes_summary"]).items():
        for value in sorted(values):
            share = summary["axes_summary"].get(axis, {}).get(value, 0) / n
            target = float(((cfg.targets or {}) if cfg else {}).get(axis, {}).get(value, 1 / len(values)))
            fine = share >= target - 0.001
            met &= fine
            out.append(f"{axis:<10} {value:<10} {100 * share:8.1f} {100 * target:8.1f} {'yes' if fine else 'no':>10}")
    out += ["", "All targets are met." if met else "Some targets are missed: candidates are too few or one-sided."]
    short = target_size is not None and n < target_size
    if short:
        out.append(f"{n} frames instead of {target_size}.")
    if short or not met:
        out += ["", "## What to try", "", *(f"* {r}" for r in REMEDIES)]
    return "\n".join(out)
