"""``python -m tamis SOURCE``: one curation run from the command line."""

from __future__ import annotations

import argparse
import logging
import sys
import time

from pyspark.sql import SparkSession

from tamis import config, logs
from tamis.functions import image
from tamis.operators import scoring
from tamis.plans import curate, manifest
from tamis.session import reach
from tamis.sources import frames
from tamis.storage import discard, exists

log = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tamis", description="Curates a diverse training set of frames from videos.")
    p.add_argument("video", help="raw videos (PPM in a row, Y4M or AVI; comma separated), a folder of PPM images (ends in /), or a Parquet table of frames")
    p.add_argument("-o", "--out", help="output folder; else named after the source")
    p.add_argument("--config", help="YAML or JSON settings")
    p.add_argument("--stride", type=int, help="take every n-th frame")
    p.add_argument("--target-size", type=int, help="frames of each video; asks for stratified selection")
    p.add_argument("--min-sharpness", type=float)
    p.add_argument("--min-contrast", type=float)
    p.add_argument("--novelty-threshold", type=float)
    p.add_argument("--dedup-method", choices=["greedy", "dbscan"])
    p.add_argument("--manifest", help="name of the manifest's file")
    p.add_argument("--overwrite", action="store_true", help="replace an output folder that is there")
    p.add_argument("--debug", action="store_true")
    return p


def read_source(spark: SparkSession, source: str, stride: int, fps: float):
    if source.endswith(".parquet"):
        return scoring.stride(spark.read.parquet(source), stride)
    if source.endswith("/"):
        return scoring.stride(frames.image_files(spark, source, fps), stride)
    spark.dataSource.register(frames.VideoSource)
    return spark.read.format("raw_video").option("paths", source).option("stride", stride).option("fallback_fps", fps).load()


def output_address(spark: SparkSession, out: str) -> str:
    """The address of an output folder. A plain path is this machine's, so it stands for one in local mode alone: elsewhere
    every executor would write to a disk of its own."""
    if "://" in out:
        return out.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError(f"{out}: on a cluster the output needs an address that all executors share, such as hdfs://...")
    return f"file://{config.Path(out).resolve()}"


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    settings = config.load_settings(args.config) if args.config else {}
    given = {k: v for k, v in vars(args).items() if k in config.RUN_DEFAULTS}
    params = config.resolve(given, settings, "cli", args.video, args.out)
    name = args.manifest or (settings.get("defaults") or {}).get("manifest") or "manifest.json"
    spark = reach(spark or SparkSession.builder.appName("tamis").getOrCreate())
    out = params["out"]["value"]
    address = output_address(spark, out)
    if exists(spark, address):
        sure = args.overwrite
        if not sure and sys.stdin.isatty():
            sure = input(f"{out} exists. Overwrite? (yes/No): ").strip().lower() in ("y", "yes")
            if not sure:
                return 0
        if not sure:
            print(f"{out} exists; --overwrite replaces it", file=sys.stderr)
            return 1
        discard(spark, address)
    if address.startswith("file://"):
        logs.to_file(address.removeprefix("file://"), args.debug)
    began = time.monotonic()
    cfg = config.with_run(config.from_settings(settings), params)
    raw = read_source(spark, args.video, params["stride"]["value"], cfg.fallback_fps)
    measured, seen, kept = scoring.observed_prefilter(image.metrics(raw), cfg)
    pool = curate.candidates(image.features(measured, cfg.image).drop("pixels"), cfg)
    log.info("pre-filter: from %d frames kept %d", seen.get["n"], kept.get["n"])
    size = params["target_size"]["value"]
    final = curate.materialise(curate.select_from(pool, cfg, size), "final")
    saved = curate.write_frames(final, raw, f"{address}/images", cfg.image_suffix, cfg.jpeg_quality)
    got = manifest.write_manifest(final, pool, cfg if settings else None, f"{address}/{name}.parts", params, time.monotonic() - began, args.video, saved)
    if got is None:
        return 0
    manifest.write_document(spark, f"{address}/{name}.parts", f"{address}/{name}")
    print(manifest.report(got, cfg, size))
    return 0
