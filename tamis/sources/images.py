"""Image files of frames, written so that each frame has exactly one, whatever fails or runs twice."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tamis.functions import jpeg
from tamis.session import reach
from tamis.sources.containers import encode_ppm

COLUMNS = "video_id string, idx long, final_ord long, t_sec double, height int, width int, pixels binary"
#: Rows of a selection up to which it is sent to all tasks instead of dealing the pixels; a row is under 100 bytes.
FEW = 100_000
LISTED = "video_id string, idx long, path string"


def file_name(final_ord: int, idx: int, t_sec: float, suffix: str = "jpg") -> str:
    return f"frame_{final_ord - 1:06d}_src{idx:06d}_t{t_sec:010.3f}.{suffix}"


@dataclass
class _Done(WriterCommitMessage):
    folder: str
    frames: int


class ImageSink(DataSource):
    """``df.write.format("frame_images")`` with the columns of ``COLUMNS``. Options: ``folder``, ``suffix`` ("jpg" or
    "ppm"), ``quality`` of JPEG files.

    An attempt of a task writes below a hidden folder of its own. When all tasks have ended, the folder of each one's
    successful attempt gets its place as ``part-<n>``, and the hidden folder goes with what other attempts have left; a job
    that fails leaves nothing. Beside its images a part has ``frames.json``, a line for each."""

    @classmethod
    def name(cls) -> str:
        return "frame_images"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _ImageWriter(self.options)


class _ImageWriter(DataSourceWriter):
    def __init__(self, options):
        self.folder = options["folder"].rstrip("/")
        self.suffix = options.get("suffix", "jpg")
        self.quality = int(options.get("quality", 95))
        if self.suffix not in ("jpg", "ppm"):
            raise ValueError(f"images of kind {self.suffix}")
        jpeg.quantisers(self.quality)
        self.job = uuid.uuid4().hex[:12]

    def _hidden(self) -> str:
        return f".writing-{self.job}"

    def write(self, iterator):
        from pyarrow import fs
        from pyspark import TaskContext

        system, root = fs.FileSystem.from_uri(self.folder)
        task = TaskContext.get()
        own = f"{self._hidden()}/{task.partitionId()}-{task.taskAttemptId()}"
        lines, made = [], set()
        for r in iterator:
            video = re.sub(r"[^\w.-]+", "_", r["video_id"] or "").strip("_")
            place = f"{video}/{file_name(r['final_ord'], r['idx'], r['t_sec'], self.suffix)}".lstrip("/")
            if video not in made:
                system.create_dir(f"{root}/{own}/{video}".rstrip("/"), recursive=True)
                made.add(video)
            image = np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"], 3)
            with system.open_output_stream(f"{root}/{own}/{place}") as out:
                out.write(jpeg.encode(image, self.quality) if self.suffix == "jpg" else encode_ppm(image))
            lines.append(json.dumps({"video_id": r["video_id"], "idx": r["idx"], "path": f"{self.folder}/part-{task.partitionId():05d}/{place}"}))
        if lines:
            with system.open_output_stream(f"{root}/{own}/frames.json") as out:
                out.write(("\n".join(lines) + "\n").encode())
        return _Done(own, len(lines))

    def commit(self, messages) -> None:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.folder)
        for message in messages:
            if message is not None and message.frames:
                n = int(message.folder.rsplit("/", 1)[1].split("-")[0])
                system.move(f"{root}/{message.folder}", f"{root}/part-{n:05d}")
        self._clear(system, root)

    def abort(self, messages) -> None:
        from pyarrow import fs

        self._clear(*fs.FileSystem.from_uri(self.folder))

    def _clear(self, system, root: str) -> None:
        from pyarrow import fs

        if system.get_file_info(f"{root}/{self._hidden()}").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/{self._hidden()}")


def write_frames(selected: DataFrame, raw: DataFrame, folder: str, suffix: str = "jpg", quality: int = 95) -> DataFrame:
    """Images of the selected frames in the new shared ``folder``; the list (video_id, idx, path) of them.

    ``selected`` should be a written table, as it is counted: up to ``FEW`` rows of it go to every task, so that ``raw``
    streams through without being dealt, pixels and all; beyond that both sides are dealt."""
    spark = reach(raw.sparkSession)
    narrow = selected.select("video_id", "idx", F.col("final_ord").cast("long").alias("final_ord"), "t_sec")
    narrow = F.broadcast(narrow) if narrow.count() <= FEW else narrow
    rows = raw.select("video_id", "idx", "height", "width", "pixels").join(narrow, ["video_id", "idx"])
    spark.dataSource.register(ImageSink)
    rows = rows.select("video_id", "idx", "final_ord", "t_sec", "height", "width", "pixels")
    rows.write.format("frame_images").mode("append").option("folder", folder).option("suffix", suffix).option("quality", quality).save()
    try:
        return spark.read.schema(LISTED).json(f"{folder}/part-*/frames.json")
    except Exception as error:  # no part has an image
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LISTED)
