"""Image metrics, scene proxies and embeddings of 8-bit BGR frames, in NumPy over Arrow batches.

Borders mirror without repeating the edge; grey is (9798 R + 19235 G + 3735 B + 16384) >> 15; the 3 x 3 blur has the
kernel [1 2 1] / 4 on either axis and rounds to integers. Gradient directions fall into left-closed sectors decided by cross
products of the integer gradients, not by a floating-point angle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tamis.session import reach


@dataclass(frozen=True)
class ImageSettings:
    noise_scale: float = 25.0
    under_below: int = 10
    over_from: int = 246
    green_threshold: float = 0.6
    hsv_bins: tuple[int, int, int] = (16, 16, 16)
    lowres: tuple[int, int] = (64, 36)
    view_bins: int = 8
    center: float = 128.0
    center_weight: float = 0.6
    clip_weight: float = 0.4
    clip_multiplier: float = 2.0


def gray(bgr: np.ndarray) -> np.ndarray:
    b, g, r = (bgr[..., i].astype(np.int64) for i in range(3))
    return (9798 * r + 19235 * g + 3735 * b + 16384) >> 15


def _around(img: np.ndarray) -> np.ndarray:
    return np.pad(img, 1, mode="reflect") if min(img.shape) > 1 else np.pad(img, 1, mode="edge")


def blur(img: np.ndarray) -> np.ndarray:
    p = _around(img)
    rows = p[:-2] + 2 * p[1:-1] + p[2:]
    return (rows[:, :-2] + 2 * rows[:, 1:-1] + rows[:, 2:] + 8) >> 4


def laplacian(img: np.ndarray) -> np.ndarray:
    p = _around(img)
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * img


def sobel(img: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = _around(img)
    right, left = p[:, 2:], p[:, :-2]
    gx = (right - left)[:-2] + 2 * (right - left)[1:-1] + (right - left)[2:]
    down, up = p[2:], p[:-2]
    gy = (down - up)[:, :-2] + 2 * (down - up)[:, 1:-1] + (down - up)[:, 2:]
    return gx, gy


def sector(gx: np.ndarray, gy: np.ndarray, bins: int = 8) -> np.ndarray:
    """0 .. ``bins`` - 1, anticlockwise from the positive x axis, each sector with its first edge.

    Within a quadrant an integer direction is compared with each edge by the sign of a cross product; edges on the axes and
    the diagonals are whole numbers, and no integer direction lies on any other edge, so the comparison is exact."""
    x, y = np.asarray(gx, np.int64), np.asarray(gy, np.int64)
    quadrant = np.select([(x > 0) & (y >= 0), (x <= 0) & (y > 0), (x < 0) & (y <= 0), (x >= 0) & (y < 0)], [0, 1, 2, 3], 0)
    u = np.choose(quadrant, [x, y, -x, -y])  # turned back into the first quadrant
    v = np.choose(quadrant, [y, -x, -y, x])
    out = quadrant * bins // 4
    for q in range(4):
        on = quadrant == q
        for k in range(q * bins // 4 + 1, bins):
            if 4 * k >= (q + 1) * bins:
                break
            if 8 * k == (2 * q + 1) * bins:
                past = v >= u
            else:
                turn = 2 * np.pi * k / bins - q * np.pi / 2
                past = v * np.cos(turn) >= u * np.sin(turn)
            out = out + (on & past)
    return np.where((x == 0) & (y == 0), 0, out)


def view_entropy(img: np.ndarray, bins: int = 8) -> float:
    gx, gy = sobel(img)
    h = np.bincount(sector(gx, gy, bins).ravel(), np.hypot(gx, gy).ravel(), minlength=bins)
    p = h / (h.sum() + 1e-9)
    return float(-(p * np.log(p + 1e-9)).sum())


def green_cover(bgr: np.ndarray, threshold: float) -> float:
    b, g, r = (bgr[..., i].astype(float) + 1e-6 for i in range(3))
    e = 2 * g - r - b
    return float(((e - e.min()) / (e.max() - e.min() + 1e-9) >= threshold).mean())


def exposure(img: np.ndarray, s: ImageSettings) -> tuple[float, float, float]:
    n = img.size
    return float(img.mean()), float((img < s.under_below).sum()) / (n + 1e-9), float((img >= s.over_from).sum()) / (n + 1e-9)


def exposure_score(mean: float, under: float, over: float, s: ImageSettings | None = None) -> float:
    s = s or ImageSettings()
    return min(1.0, max(0.0, 1 - min(1.0, s.center_weight * abs(mean - s.center) / s.center + s.clip_weight * s.clip_multiplier * (under + over))))


def hsv(bgr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue in [0, 180), saturation and value in [0, 256)."""
    b, g, r = (bgr[..., i].astype(float) for i in range(3))
    v, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    d = v - low
    safe = np.where(d == 0, 1, d)
    h = np.where(v == r, 60 * (g - b) / safe, np.where(v == g, 120 + 60 * (b - r) / safe, 240 + 60 * (r - g) / safe))
    h = np.where(d == 0, 0, np.where(h < 0, h + 360, h)) / 2
    s = np.where(v == 0, 0, 255 * d / np.where(v == 0, 1, v))
    return np.floor(h + 0.5) % 180, np.floor(s + 0.5), v


def unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x) + 1e-9)


def hsv_histogram(bgr: np.ndarray, bins: tuple[int, int, int]) -> np.ndarray:
    parts = [np.bincount(np.minimum(c.ravel() * n // top, n - 1).astype(int), minlength=n) for c, n, top in zip(hsv(bgr), bins, (180, 256, 256), strict=True)]
    return unit(np.concatenate(parts).astype(float))


def low_resolution(bgr: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """Area means over a grid of (width, height) cells, in grey, centred, of unit length."""
    h, w = bgr.shape[:2]
    rows, cols = _area(h, size[1]), _area(w, size[0])
    small = np.stack([np.floor(rows @ bgr[..., i].astype(float) @ cols.T + 0.5) for i in range(3)], axis=-1)
    g = gray(small).astype(float)
    return unit((g - g.mean()).ravel())


def _area(n: int, cells: int) -> np.ndarray:
    """(cells, n) weights of each pixel in each cell, in proportion to the overlap."""
    edge = np.arange(cells + 1) * n / cells
    lo, hi = edge[:-1, None], edge[1:, None]
    at = np.arange(n)[None, :]
    return np.clip(np.minimum(hi, at + 1) - np.maximum(lo, at), 0, None) / (hi - lo)


def embedding(bgr: np.ndarray, s: ImageSettings) -> np.ndarray:
    return unit(np.concatenate([hsv_histogram(bgr, s.hsv_bins), low_resolution(bgr, s.lowres)]))


METRICS = ("sharpness", "contrast")
FEATURES = ("mean", "under", "over", "exposure_score", "noise_score", "hf_energy", "view_entropy", "green_cover", "lighting_mean")


def metrics(frames: DataFrame) -> DataFrame:
    """Adds sharpness and contrast, the two that the prefilter needs."""

    def measure(bgr: np.ndarray) -> tuple:
        g = gray(bgr)
        return float(laplacian(g).var()), float(g.std())

    return _measured(frames, measure, METRICS, ())


def features(frames: DataFrame, settings: ImageSettings | None = None) -> DataFrame:
    """Adds the other metrics, the scene proxies and the embedding; run after the prefilter."""
    s = settings or ImageSettings()

    def measure(bgr: np.ndarray) -> tuple:
        g = gray(bgr)
        rest = g - blur(g)
        mean, under, over = exposure(g, s)
        noise = max(0.0, 1 - min(1.0, float(rest.std()) / s.noise_scale))
        return mean, under, over, exposure_score(mean, under, over, s), noise, float(np.abs(rest).mean()), view_entropy(g, s.view_bins), green_cover(bgr, s.green_threshold), mean, embedding(bgr, s)

    return _measured(frames, measure, FEATURES, ("embed",))


def _measured(frames: DataFrame, measure, numbers: tuple[str, ...], vectors: tuple[str, ...]) -> DataFrame:
    reach(frames.sparkSession)
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema), *(f"{n} double" for n in numbers), *(f"{v} array<float>" for v in vectors)])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                shapes = zip(*(part.column(c).to_pylist() for c in ("pixels", "height", "width")), strict=True)
                got = [measure(np.frombuffer(p, np.uint8).reshape(h, w, 3)) for p, h, w in shapes]
                new = [pa.array([r[i] for r in got], pa.float64()) for i in range(len(numbers))]
                new += [pa.array([r[len(numbers) + i].astype(np.float32) for r in got], pa.list_(pa.float32())) for i in range(len(vectors))]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *numbers, *vectors])

    return frames.mapInArrow(run, kinds)
