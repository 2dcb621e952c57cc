"""Ordered folds: operators whose state depends on every earlier row of a collection.

Rows are dealt by collection and sorted inside the partitions, then stream through the fold once, run by run of one
collection's rows; memory holds the state and a batch, never a collection. A single collection is sequential by definition,
many run in parallel. Stratified selection reads its ranking range by range, and hands its state from one to the next.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tamis.config import Config
from tamis.functions.vectors import matrix, units
from tamis.session import reach
from tamis.storage import materialise

#: Frames whose cosines are computed at once.
FRAMES = 64


def runs(batch: pa.RecordBatch, key: str) -> Iterator[tuple[object, pa.RecordBatch]]:
    """The batch in slices of consecutive rows of one key."""
    keys = batch.column(key).to_pylist()
    lo = 0
    for hi in range(1, len(keys) + 1):
        if hi == len(keys) or keys[hi] != keys[lo]:
            yield keys[lo], batch.slice(lo, hi - lo)
            lo = hi


def ordered_fold(df: DataFrame, key: str, order: list[str], added: str, start: Callable[[], Callable]) -> DataFrame:
    """``df`` with the columns of ``added`` (a schema string). ``start`` makes a collection's step function, which takes a
    run of its next rows as a batch and returns the added columns."""
    reach(df.sparkSession)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    names = [x.split()[0] for x in added.split(", ")]

    def run(batches):
        now, step = object(), None
        for batch in batches:
            for found, part in runs(batch, key):
                if found != now:
                    now, step = found, start()
                yield pa.RecordBatch.from_arrays([*part.columns, *step(part)], names=[*part.schema.names, *names])

    dealt = df.repartition(F.col(key)).sortWithinPartitions(key, *order)
    return dealt.mapInArrow(run, f"{kinds}, {added}")


class Novelty:
    """1 - the largest cosine of each next frame with the last ``memory`` prototypes (all of them for 0); a frame becomes a
    prototype when its novelty exceeds the threshold.

    A block's products with the prototypes and with itself are two matrix products; the frames are then gone through one by
    one over their entries alone. Prototypes lie in order in a buffer that is moved once it is full."""

    def __init__(self, memory: int, threshold: float, kept: np.ndarray | None = None):
        self.memory, self.threshold = memory, threshold
        self.buffer = np.zeros((0, 0)) if kept is None else np.array(kept, np.float64)
        self.lo, self.hi = 0, len(self.buffer)

    @property
    def kept(self) -> np.ndarray:
        """The present prototypes, oldest first."""
        return self.buffer[self.lo : self.hi]

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        every = units(np.asarray(vectors, np.float64))
        return np.concatenate([self._block(every[k : k + FRAMES]) for k in range(0, len(every), FRAMES)] or [np.zeros(0)])

    def _block(self, unit: np.ndarray) -> np.ndarray:
        p, n = self.hi - self.lo, len(unit)
        #: Column k: the largest cosine with any prototype from the k-th on.
        since = np.maximum.accumulate((unit @ self.kept.T)[:, ::-1], axis=1)[:, ::-1] if p else None
        inner = unit @ unit.T
        out, new = np.ones(n), []
        for i in range(n):
            gone = max(0, p + len(new) - self.memory) if self.memory else 0
            best = since[i, gone] if gone < p else -np.inf
            if new:
                best = max(best, inner[i, new[max(0, gone - p) :]].max())
            if p or new:
                out[i] = min(1.0, max(0.0, 1.0 - best))
            if out[i] > self.threshold:
                new.append(i)
        self._add(unit[new])
        return out

    def _add(self, more: np.ndarray) -> None:
        if self.memory:
            more = more[-self.memory :]
        if not len(more):
            return
        if self.hi + len(more) > len(self.buffer):
            wide = np.zeros((2 * max(self.memory, self.hi - self.lo + len(more), 1), more.shape[1]))
            now = self.kept
            wide[: len(now)] = now if len(now) else 0
            self.buffer, self.lo, self.hi = wide, 0, len(now)
        self.buffer[self.hi : self.hi + len(more)] = more
        self.hi += len(more)
        if self.memory:
            self.lo = max(self.lo, self.hi - self.memory)


def score_frames(frames: DataFrame, cfg: Config) -> DataFrame:
    """Adds ``quality``, ``content_novelty`` and ``ml_score``; frames are taken in the order of ``idx``."""
    from tamis.operators.scoring import quality

    def start():
        fold = Novelty(cfg.novelty_memory, cfg.novelty_threshold)
        return lambda part: [pa.array(fold(matrix(part.column("embed"))))]

    folded = ordered_fold(frames.withColumn("quality", quality(cfg)), "video_id", ["idx"], "content_novelty double", start)
    return folded.withColumn("ml_score", F.lit(cfg.quality_weight) * F.col("quality") + F.lit(cfg.novelty_weight) * F.col("content_novelty"))


class Stratified:
    """Whether a frame is accepted, best scores first: never a sparse one beyond the cap, else one whose combination is below
    its target share or that scores above the high-quality threshold. The state is a few numbers and goes to JSON and back."""

    def __init__(self, targets: dict[str, float], size: int, cfg: Config, state: str | None = None):
        self.targets, self.size, self.cap, self.high = targets, size, cfg.sparse_cap, cfg.high_quality
        self.n, self.sparse, self.passed, self.counts = json.loads(state) if state else (0, 0, 0, {})

    def state(self) -> str:
        return json.dumps([self.n, self.sparse, self.passed, self.counts])

    @property
    def full(self) -> bool:
        return self.n >= self.size

    def take(self, key: str, cover: str, score: float) -> bool:
        sparse = cover == "sparse"
        fits = not (sparse and self.n and self.sparse / self.n >= self.cap)
        if fits:
            share = self.counts.get(key, 0) / self.n if self.n else 0.0
            fits = share < self.targets.get(key, 0.0) or score > self.high
        if fits:
            self.counts[key] = self.counts.get(key, 0) + 1
            self.n += 1
            self.sparse += sparse
        else:
            self.passed += 1
        return fits


def stratified_ranges(ranking: DataFrame, targets: dict[str, float], size: int, cfg: Config) -> DataFrame:
    """(video_id, idx, rank, pick, nth) of ``ranking(video_id, idx, rank, span, total, combo_key, cover, ml_score)``: accepted
    frames with the number of their pick, and the best frames passed over, at most ``size`` of each collection, with theirs.

    A round reads one span of ranks of the collections that are neither full nor at their end, and starts from the state
    that the last round has written; spans grow, so rounds are few, and ranks after acceptance has ended are not read."""
    spark = reach(ranking.sparkSession)
    kind = "video_id string, idx long, rank long, pick long, nth long, state string"
    columns = [x.split()[0] for x in kind.split(", ")]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(batches):
        now, fold, last, total = None, None, 0, 0

        def ended():
            waits = fold.state() if not fold.full and last < total else None
            return [(now[0], None, None, None, None, waits)] if waits else []

        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("video_id", "state", "idx", "rank", "total", "combo_key", "cover", "ml_score")), strict=True)
            for video, state, idx, rank, of, key, cover, score in rows:
                if (video,) != now:
                    out += ended() if now else []
                    now, fold, last, total = (video,), Stratified(targets, size, cfg, state), 0, 0
                if idx is None or fold.full:
                    continue
                last, total = rank, of
                if fold.take(key, cover, score):
                    out.append((video, idx, rank, fold.n, None, None))
                elif fold.passed <= size:
                    out.append((video, idx, rank, None, fold.passed, None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)], names=columns)
        if now and ended():
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*ended(), strict=True), kinds, strict=True)], names=columns)

    wanted = ["video_id", "idx", "rank", "total", "combo_key", "cover", "ml_score"]
    found, states, span = None, None, 0
    while size > 0:
        rows = ranking.where(F.col("span") == span).select(*wanted).withColumn("state", F.lit(None).cast("string"))
        if states is not None:
            rows = rows.join(states.select("video_id"), "video_id", "left_semi").unionByName(states.select("video_id", "state"), allowMissingColumns=True)
        waiting = Observation()
        dealt = rows.repartition("video_id").sortWithinPartitions("video_id", F.col("rank").asc_nulls_first())
        now = materialise(dealt.mapInArrow(run, kind).observe(waiting, F.count("state").alias("n")), "picks")
        made = now.where("state IS NULL").drop("state")
        found = made if found is None else found.unionByName(made)
        if not waiting.get["n"]:
            break
        states, span = now.where("state IS NOT NULL"), span + 1
    return found if found is not None else spark.createDataFrame([], kind).drop("state")
