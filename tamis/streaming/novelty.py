"""Frames as a stream: stateless scoring, and novelty with state for each collection.

``score_stream`` takes frames that arrive in order. ``score_late_stream`` puts them in order first: frames wait in the state
until the watermark has passed their time, and are then released by ``idx``, so that any order of arrival within the
watermark's delay gives the results of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tamis.config import Config
from tamis.operators.folds import Novelty
from tamis.operators.scoring import prefilter, quality
from tamis.session import reach


def score_stream(frames: DataFrame, cfg: Config) -> DataFrame:
    """(video_id, idx, quality, content_novelty, ml_score) of a stream of prefiltered frames. The state of a collection
    is its last prototypes; each micro-batch is taken in the order of ``idx``, so frames must arrive in that order."""
    reach(frames.sparkSession)
    memory, threshold = cfg.novelty_memory, cfg.novelty_threshold
    a, b = cfg.quality_weight, cfg.novelty_weight

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        flat, size = state.get if state.exists else ([], 0)
        fold = Novelty(memory, threshold, np.asarray(flat, float).reshape(-1, size) if size else None)
        rows = pd.concat(list(batches)).sort_values("idx")
        novelty = fold(np.stack(rows["embed"].to_numpy()))
        state.update((fold.kept.ravel().tolist(), fold.kept.shape[1] if len(fold.kept) else 0))
        quality = rows["quality"].to_numpy()
        yield pd.DataFrame({"video_id": key[0], "idx": rows["idx"].to_numpy(), "quality": quality, "content_novelty": novelty, "ml_score": a * quality + b * novelty})

    scored = prefilter(frames, cfg).select("video_id", "idx", "embed", quality(cfg).alias("quality"))
    return scored.groupBy("video_id").applyInPandasWithState(
        step, "video_id string, idx long, quality double, content_novelty double, ml_score double", "protos array<double>, size int", "append", GroupStateTimeout.NoTimeout
    )


_SCORES = "video_id string, idx long, quality double, content_novelty double, ml_score double, late boolean"


class _InOrder(StatefulProcessor):
    """The frames of a collection that wait, and its fold. A timer at a frame's time fires once the watermark passes it; what
    has come due is released in order, and a frame that comes behind the watermark or behind released ones is only listed."""

    def __init__(self, memory: int, threshold: float, weights: tuple[float, float]):
        self.memory, self.threshold, self.weights = memory, threshold, weights

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, idx long, quality double, embed array<double>")
        self.fold = handle.getValueState("fold", "protos array<double>, size int, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, mark = self._last(), timerValues.getCurrentWatermarkInMs()
        times = set()
        for part in rows:
            behind = (part["idx"] <= last) | (part["at"] <= mark)
            late, fresh = part[behind], part[~behind]
            if len(fresh):
                at = fresh["at"].astype("int64").to_numpy()
                self.waiting.appendList([(int(t), int(i), float(q), [float(x) for x in e]) for t, i, q, e in zip(at, fresh["idx"], fresh["quality"], fresh["embed"], strict=True)])
                times |= set(at.tolist())
            if len(late):
                n = len(late)
                yield pd.DataFrame({"video_id": [key[0]] * n, "idx": late["idx"].to_numpy(), "quality": late["quality"].to_numpy(), "content_novelty": [None] * n, "ml_score": [None] * n, "late": [True] * n})
        for t in times:
            self.handle.registerTimer(t)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = sorted(self.waiting.get(), key=lambda r: r[1])
        due = [r for r in held if r[0] <= mark]
        if not due:
            return
        last_due = max(r[1] for r in due)
        due = [r for r in held if r[1] <= last_due]  # in the order of idx, whatever their times
        rest = [tuple(r) for r in held if r[1] > last_due]
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        flat, size, _ = self.fold.get() if self.fold.exists() else ([], 0, -1)
        fold = Novelty(self.memory, self.threshold, np.asarray(flat, float).reshape(-1, size) if size else None)
        novelty = fold(np.array([r[3] for r in due], float))
        kept = fold.kept
        self.fold.update(([float(x) for x in kept.ravel()], kept.shape[1] if len(kept) else 0, int(due[-1][1])))
        quality = np.array([r[2] for r in due])
        a, b = self.weights
        yield pd.DataFrame({"video_id": key[0], "idx": [int(r[1]) for r in due], "quality": quality, "content_novelty": novelty, "ml_score": a * quality + b * novelty, "late": False})

    def _last(self) -> int:
        return self.fold.get()[2] if self.fold.exists() else -1

    def close(self) -> None:
        pass


#: The store of state that timers need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def score_late_stream(frames: DataFrame, cfg: Config, time: str = "seen_at", delay: str = "10 seconds") -> DataFrame:
    """``score_stream`` for frames in any order, by their event time ``time`` (a timestamp that grows with ``idx``): rows are
    released once the watermark, ``delay`` behind the latest time seen, has passed them. Every frame that came behind the watermark
    is counted: it is listed as ``late``, without scores, or the engine, whose own check goes by the watermark of the batch
    before, has dropped it and says so in its progress (``numRowsDroppedByWatermark``). The session's state store must be
    ``STATE_STORE``."""
    reach(frames.sparkSession)
    scored = prefilter(frames, cfg).withWatermark(time, delay)
    rows = scored.select("video_id", "idx", "embed", quality(cfg).alias("quality"), time, F.unix_millis(time).alias("at"))
    process = _InOrder(cfg.novelty_memory, cfg.novelty_threshold, (cfg.quality_weight, cfg.novelty_weight))
    return rows.groupBy("video_id").transformWithStateInPandas(process, _SCORES, "append", "EventTime")
