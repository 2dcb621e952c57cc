"""Videos that are read by many tasks, and images that are written once."""

import io
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.functions import image, jpeg
from tamis.sources import containers, frames, images

RNG = np.random.default_rng(3)


def pictures(n, h=5, w=7):
    return [RNG.integers(0, 256, (h, w, 3)).astype(np.uint8) for _ in range(n)]


def file_of(kind, every, fps=12.0):
    writer = containers.Writer(kind, *every[0].shape[:2], len(every), fps)
    return writer.start() + b"".join(map(writer.frame, every)) + writer.end()


def read(data, most=300, walk=False):
    file = io.BytesIO(data)
    found = containers.walked(file, len(data)) if walk else containers.index(file, len(data), most)
    out = []
    for lo, hi in found.parts(most):
        part = found.part(lo, hi)
        for k in range(part.n):
            at, n = part.place(k)
            out.append(containers.decode(part, data[at : at + n]))
    return found, out


def same(a, b):
    return len(a) == len(b) and all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("torn", [0, 1, 40])
def test_indexes(torn):
    every = pictures(20)
    kept = every if not torn else every[:-1]
    ppm = file_of("ppm", every)
    assert same(read(ppm[: len(ppm) - torn])[1], kept)
    assert same(read(ppm + b"P6 7 5 255\nxx")[1], every)
    avi = file_of("avi", every)
    found, got = read(avi)
    assert same(got, every) and found.fps == pytest.approx(12.0, abs=1e-3)
    table = avi.index(b"idx1")
    assert same(read(avi[: table - torn])[1], kept)  # without its table, the frames are walked
    grey = [np.repeat(image.gray(x)[..., None], 3, 2) for x in every]
    y4m = file_of("y4m", every)
    found, got = read(y4m[: len(y4m) - torn])
    assert same(got, grey[: len(kept)]) and found.fps == 12.0


def test_images_of_several_sizes():
    every = [x for h in (3, 40, 1, 7) for x in pictures(3, h)]
    data = b"".join(map(containers.encode_ppm, every))
    assert same(read(data, walk=True)[1], every) and same(read(data, 200)[1], every)
    for nothing in (b"", b"P6 1 1 65535\nxxxxxx", b"GIF89a"):
        assert read(nothing)[1] == []


def test_colours_of_y4m():
    flat = np.concatenate([np.full(24, 81), np.full(6, 90), np.full(6, 240)]).astype(np.uint8)
    found, got = read(b"YUV4MPEG2 W6 H4 F25:1 C420jpeg\nFRAME\n" + flat.tobytes())
    assert found.n == 1 and (np.abs(got[0].astype(int) - (0, 0, 254)) <= 2).all()
    with pytest.raises(ValueError):
        read(b"YUV4MPEG2 W6 H4 C420p10\nFRAME\n")


@pytest.mark.parametrize("kind", ["ppm", "avi"])
def test_one_file_in_many_tasks(spark, tmp_path, kind):
    every = pictures(64, 8, 8)
    (tmp_path / f"a.{kind}").write_bytes(file_of(kind, every))
    spark.dataSource.register(frames.VideoSource)
    got = spark.read.format("raw_video").option("paths", str(tmp_path / f"a.{kind}")).option("partition_bytes", 1000).option("stride", 3).load()
    assert got.rdd.getNumPartitions() >= 8
    rows = got.withColumn("task", F.spark_partition_id()).orderBy("idx").collect()
    assert [r["idx"] for r in rows] == list(range(0, 64, 3)) and len({r["task"] for r in rows}) >= 8
    assert all(bytes(r["pixels"]) == every[r["idx"]].tobytes() for r in rows)


def decoded(spark, data):
    jvm = spark._jvm
    got = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(data))
    w, h = got.getWidth(), got.getHeight()
    px = np.array(list(got.getRGB(0, 0, w, h, None, 0, w)), np.int64) & 0xFFFFFFFF
    return np.stack([px & 255, px >> 8 & 255, px >> 16 & 255], -1).reshape(h, w, 3)


def test_jpeg_by_another_decoder(spark):
    y, x = np.mgrid[0:45, 0:61]
    smooth = np.stack([x * 4, y * 5, (x + y) * 2], -1).clip(0, 255).astype(np.uint8)
    noise = RNG.integers(0, 256, (37, 50, 3)).astype(np.uint8)
    grey = np.repeat(noise[..., :1], 3, 2)
    off = lambda x, *how: np.abs(decoded(spark, jpeg.encode(x, *how)) - x.astype(int))
    assert off(smooth).max() <= 8 and off(smooth).mean() < 1
    assert off(noise, 100, False).max() <= 4 and off(grey, 95).mean() < 4
    for part in (smooth[:1, :1], smooth[:8, :8], smooth[:9, :17], np.zeros((16, 16, 3), np.uint8)):
        assert off(part).max() <= 8
    assert len(jpeg.encode(noise, 20)) < len(jpeg.encode(noise, 60)) < len(jpeg.encode(noise, 95))
    for bad in (0, 101):
        with pytest.raises(ValueError):
            jpeg.encode(smooth, bad)


def test_code_lengths():
    from collections import Counter

    for counts in (Counter({5: 1}), Counter({i: 1 << i for i in range(40)}), Counter({i: 1 for i in range(200)})):
        lengths = jpeg.code_lengths(counts)
        assert lengths.keys() == counts.keys() and max(lengths.values()) <= 16
        assert sum(2.0**-d for d in lengths.values()) <= 1 - 2.0**-16  # a code of ones is left
    assert list(jpeg.ZIGZAG[:10]) == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24]


ROWS = [("a b", i, i + 1, i / 10, 5, 7, bytearray(RNG.integers(0, 256, 105, dtype=np.uint8).tobytes())) for i in range(12)]


def test_sink_writes_each_frame_once(spark, tmp_path):
    """A task that fails midway is tried again (here by a failing job after a good one), and leaves nothing."""
    df = spark.createDataFrame(ROWS, images.COLUMNS).repartition(3)
    listed = images.write_frames(df.drop("height", "width", "pixels"), df, f"file://{tmp_path}/out")
    paths = sorted(r["path"] for r in listed.collect())
    found = sorted(f"file://{p}" for p in (tmp_path / "out").rglob("frame_*.jpg"))
    assert paths == found and len({p.rsplit("/", 1)[1] for p in paths}) == 12
    assert {p.rsplit("/", 2)[1] for p in paths} == {"a_b"} and paths[0].endswith(".jpg")
    assert not list((tmp_path / "out").glob(".writing*"))
    got = spark.read.format("image").load(f"{tmp_path}/out/part-*/*/*.jpg").selectExpr("image.width", "image.height").distinct().collect()
    assert [(r[0], r[1]) for r in got] == [(7, 5)]
    spark.dataSource.register(images.ImageSink)
    bad = spark.createDataFrame([*ROWS, ("z", 99, 13, 0.0, 5, 7, bytearray(b"short"))], images.COLUMNS).repartition(3)
    with pytest.raises(Exception):  # noqa: B017
        bad.write.format("frame_images").mode("append").option("folder", f"file://{tmp_path}/bad").save()
    assert not [p for p in (tmp_path / "bad").rglob("*") if p.is_file()]
    none = images.write_frames(df.where("false"), df, f"file://{tmp_path}/none")
    assert none.count() == 0


def test_only_the_committed_attempt_counts(tmp_path):
    """Two attempts of one task have written; the one that is committed gets the place."""
    writer = images._ImageWriter({"folder": f"file://{tmp_path}"})
    for attempt in (7, 8):
        at = tmp_path / f"{writer._hidden()}/0-{attempt}/v"
        at.mkdir(parents=True)
        (at / "frame.jpg").write_text(str(attempt))
    writer.commit([images._Done(f"{writer._hidden()}/0-8", 1), images._Done(f"{writer._hidden()}/1-9", 0), None])
    assert [p.read_text() for p in tmp_path.rglob("frame.jpg")] == ["8"] and (tmp_path / "part-00000/v/frame.jpg").exists()
    shutil.rmtree(tmp_path)
    tmp_path.mkdir()
    writer.abort([])
