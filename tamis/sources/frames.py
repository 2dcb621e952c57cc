"""Frames: the views over the test tables, and readers and writers of raw images.

Raw videos (PPM images in a row, Y4M, AVI without compression) are read by many tasks each; there is no decoder of
compressed ones, for which Parquet tables of pixels stand in. A table of frames is (video_id, idx, t_sec, height, width, pixels) with pixels as BGR bytes.
"""

from __future__ import annotations

import re
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tamis.session import reach
from tamis.sources.containers import PPM, Index, Writer, decode, encode_ppm, index, walked
from tamis.storage import materialise

__all__ = ["FRAMES", "VideoSource", "decode_ppm", "encode_ppm", "image_files", "image_view", "light_view", "write_videos"]

#: Bytes of a video that a task reads, about.
PART = 64 << 20
FRAMES = "video_id string, idx long, t_sec double, height int, width int, pixels binary"


def light_view(spark: SparkSession, sf_dir: str, one_video: bool = False) -> DataFrame:
    """Frames without pixels from the vectors and the events of the same number."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    v = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value", "user_id")
    d = "double"
    video = F.lit("v") if one_video else F.concat(F.lit("v"), F.col("label").cast("string"))
    return e.join(v, F.col("event_id") == F.col("vec_id")).select(
        video.alias("video_id"),
        F.col("vec_id").alias("idx"),
        (F.col("vec_id") / F.lit(30.0)).alias("t_sec"),
        F.col("embedding").alias("embed"),
        (F.lit(40.0) + F.lit(4.0) * F.col("value")).alias("sharpness"),
        (F.lit(15) + F.col("vec_id") * 37 % 70).cast(d).alias("contrast"),
        ((F.col("vec_id") * 53 % 101) / F.lit(100.0)).alias("exposure_score"),
        ((F.col("user_id") * 29 % 101) / F.lit(100.0)).alias("noise_score"),
        F.col("value").alias("hf_energy"),
        (F.lit(1.205) + (F.col("vec_id") * 31 % 90) / F.lit(100.0)).alias("view_entropy"),
        ((F.col("vec_id") * 17 % 101) / F.lit(100.0)).alias("green_cover"),
        (F.lit(60) + F.col("vec_id") * 13 % 120).cast(d).alias("lighting_mean"),
    )


def image_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 frames whose pixels are the vectors' values."""
    reach(spark)

    def run(batches):
        for batch in batches:
            v = np.array(batch.column("embedding").to_pylist(), np.float64).reshape(-1, 64)
            px = np.clip(np.floor(128 + 400 * v), 0, 255).astype(np.uint8)
            bgr = np.stack([px, np.roll(px, -21, axis=1), np.roll(px, -42, axis=1)], axis=-1)
            ids = batch.column("vec_id")
            n = len(ids)
            video = pa.array([f"v{x}" for x in batch.column("label").to_pylist()])
            t = pa.array(np.array(ids.to_pylist(), float) / 30.0)
            eight = pa.array([8] * n, pa.int32())
            yield pa.RecordBatch.from_arrays([video, ids, t, eight, eight, pa.array([x.tobytes() for x in bgr], pa.binary())], names=["video_id", "idx", "t_sec", "height", "width", "pixels"])

    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").mapInArrow(run, FRAMES)


def decode_ppm(data: bytes) -> np.ndarray:
    """The BGR image of a binary PPM file; what follows the image is left aside."""
    head = PPM.match(data)
    if not head or int(head[3]) != 255:
        raise ValueError("not an 8-bit binary PPM image")
    w, h = int(head[1]), int(head[2])
    rgb = np.frombuffer(data[head.end() : head.end() + 3 * w * h], np.uint8).reshape(h, w, 3)
    return np.ascontiguousarray(rgb[..., ::-1])


def write_videos(raw: DataFrame, folder: str, kind: str = "ppm", fps: float = 30.0) -> DataFrame:
    """(video_id, path): each collection's frames in the order of ``idx``, streamed into one file. ``kind`` is "ppm" (images
    in a row), "y4m" (grey) or "avi" (24-bit pixels with an index); the frames of a collection have one size. A task writes
    below a folder of its attempt's name, and only the paths of finished tasks are listed."""
    reach(raw.sparkSession)
    counted = raw.join(raw.groupBy("video_id").agg(F.count("*").alias("frames")), "video_id")

    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        system, root = fs.FileSystem.from_uri(folder)
        attempt, now, out, writer, done = TaskContext.get().taskAttemptId(), None, None, None, []

        def close():
            if out:
                out.write(writer.end())
                out.close()

        for batch in batches:
            for video, h, w, pixels, n in zip(*(batch.column(c).to_pylist() for c in ("video_id", "height", "width", "pixels", "frames")), strict=True):
                if video != now:
                    close()
                    name = f"{attempt}/{video}.{kind}"
                    system.create_dir(f"{root}/{attempt}", recursive=True)
                    out, now, writer = system.open_output_stream(f"{root}/{name}"), video, Writer(kind, h, w, n, fps)
                    out.write(writer.start())
                    done.append((video, f"{folder}/{name}"))
                out.write(writer.frame(np.frombuffer(pixels, np.uint8).reshape(h, w, 3)))
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in range(2)], names=["video_id", "path"])

    dealt = counted.select("video_id", "idx", "height", "width", "pixels", "frames").repartition("video_id").sortWithinPartitions("video_id", "idx")
    return materialise(dealt.mapInArrow(run, "video_id string, path string"), "videos")


class VideoSource(DataSource):
    """``spark.read.format("raw_video")``: frames of PPM images in a row, of Y4M and of AVI files, by their first bytes.

    Options: ``paths`` (comma separated), ``stride`` (every n-th frame; the others are not read), ``fps`` (in place of the
    file's), ``partition_bytes`` (about what a task reads), ``index`` ("walk" for PPM images of several sizes that a look at
    the parts' first frames does not tell). A file is split into parts of whole frames; a path that cannot be opened fails;
    a torn image ends its video."""

    @classmethod
    def name(cls) -> str:
        return "raw_video"

    def schema(self) -> str:
        return FRAMES

    def reader(self, schema) -> DataSourceReader:
        return _VideoReader(self.options)


class _Part(InputPartition):
    def __init__(self, path: str, lo: int, frames: Index):
        self.path, self.lo, self.frames = path, lo, frames


class _VideoReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(",") if p]
        self.stride = int(options.get("stride", 1)) or 1
        self.fps = float(options.get("fps", 0)) or None
        self.fallback = float(options.get("fallback_fps", 0)) or 30.0
        self.most = int(options.get("partition_bytes", PART))
        self.walk = options.get("index", "") == "walk"

    def partitions(self):
        from pyarrow import fs

        out = []
        for path in self.paths:
            system, at = fs.FileSystem.from_uri(path)
            with system.open_input_file(at) as file:
                found = walked(file, file.size()) if self.walk else index(file, file.size(), self.most)
            out += [_Part(path, lo, found.part(lo, hi)) for lo, hi in found.parts(self.most)]
        return out or [_Part("", 0, Index("ppm", 0, 0, 0))]

    def read(self, partition):
        from pyarrow import fs

        found = partition.frames
        if not found.n:
            return
        fps = self.fps or found.fps or self.fallback
        system, at = fs.FileSystem.from_uri(partition.path)
        with system.open_input_file(at) as file:
            for k in range(-partition.lo % self.stride, found.n, self.stride):
                place, length = found.place(k)
                file.seek(place)
                image = decode(found, file.read(length))
                idx = partition.lo + k
                yield (partition.path, idx, idx / fps, image.shape[0], image.shape[1], image.tobytes())


def image_files(spark: SparkSession, path: str, fps: float = 30.0) -> DataFrame:
    """Single PPM files of a folder as frames of one video each folder, numbered by the last digits of their names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ppm").load(path)

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                image = decode_ppm(content)
                digits = re.findall(r"\d+", name.rsplit("/", 1)[-1])
                idx = int(digits[-1]) if digits else 0
                row = [name.rsplit("/", 1)[0], idx, idx / fps, image.shape[0], image.shape[1], image.tobytes()]
                kinds = (pa.string(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["video_id", "idx", "t_sec", "height", "width", "pixels"])

    reach(spark)
    return files.select("path", "content").mapInArrow(run, FRAMES)
