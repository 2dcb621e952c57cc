"""Hard negatives from vectors by a vector-approximation file.

Vectors are integers. The file holds, for blocks of rows, each component's cell (one of ``CELLS`` equal ranges between the
dimension's least and largest value, a byte) beside the exact values. For an anchor, the least and the largest product of
its component with any value of a cell stand in a table, so a row's score lies between two sums of table look-ups. A task
meets one bucket of anchors with one group of blocks, keeps the best scores so far of each anchor's window, and computes
exactly only those rows whose upper bound may still enter one; what it keeps for each window goes on to one ranking.

Two passes: an anchor's positives are its best rows of the same label; each positive's score makes a window, and the
negatives are the best rows of other labels within it. Anchors are a stated share of the rows, and every anchor meets every
row, so work grows with the product of both; buckets and groups have bounded sizes whatever the labels' shares.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import arrow_map, materialise
from tamis.session import reach

CELLS = 256
#: Rows of a block, blocks of a group, and anchors times dimensions of a bucket (about).
ROWS, BLOCKS, ENTRIES = 1024, 8, 1 << 14
#: Tasks of a search at most; each may take many buckets and groups in turn.
TASKS = 10_000
#: Fixed values of the contract: rows of each list, and the share of a positive's score between which negatives lie.
POSITIVES, NEGATIVES, LOWEST, HIGHEST = 5, 10, (30, 100), (90, 100)


def prepared(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 256, moved: int = 7, labels: int = 10) -> DataFrame:
    """(id, label, vector): integer components floor(``scale`` * x); where ``moved`` divides the id, the next of ``labels``
    labels. Rows take no part if their id, label or vector is null, or any component is null or not finite."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & v.isNotNull()
    fine &= F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    key, label = F.col(f"`{id_col}`").cast("long"), F.col(f"`{label_col}`").cast("long")
    label = F.when(key % moved == 0, (label + 1) % labels).otherwise(label)
    return rows.where(fine).select(key.alias("id"), label.alias("label"), F.transform(v, lambda x: F.floor(x * scale)).alias("vector"))


def _packed(vectors: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out[np.arange(width) < counts[:, None]] = flat
    return out


@dataclass
class Approximation:
    """``blocks(block, n, id, label, cell, exact)``: binary columns of ``n`` rows each; the dimensions' least values and the
    widths of their cells."""

    blocks: DataFrame
    low: np.ndarray
    step: np.ndarray
    rows: int


def approximation(vectors: DataFrame) -> Approximation:
    """The vector-approximation file of ``vectors(id, label, vector)``, a written table that is read three times."""

    def ends():
        def step(batch):
            v = batch.column("vector")
            width = int(pc.max(pc.list_value_length(v)).as_py() or 0)
            m = _packed(v, width)
            yield pa.RecordBatch.from_arrays([pa.array([width] * width, pa.int32()), pa.array(np.arange(width), pa.int32()), pa.array(m.min(0)), pa.array(m.max(0)), pa.array([len(m)] * width, pa.int64())], names=["width", "at", "low", "high", "n"])

        return step

    ranges = arrow_map(vectors, ["vector"], "width int, at int, low long, high long, n long", ends)
    # a row for each dimension; a vector that lacks a dimension counts as zero there
    found = ranges.groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("width").alias("least")).orderBy("at").collect()
    rows = vectors.count()
    width = len(found)
    short = vectors.where(F.size("vector") < width).limit(1).count() if width else 0
    low = np.array([min(r["low"], 0) if short else r["low"] for r in found], np.int64)
    high = np.array([max(r["high"], 0) if short else r["high"] for r in found], np.int64)
    if width * max((abs(int(x)) for x in (*low, *high)), default=0) ** 2 >= 1 << 60:
        raise ValueError("components too large for scores of 64 bits")
    step = np.maximum(1, -(-(high - low + 1) // CELLS))

    def pack():
        pid, seq = TaskContext.get().partitionId(), [0]

        def run(batch):
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                m = _packed(part.column("vector"), width)
                cell = ((m - low) // step).astype(np.uint8)
                columns = [part.column(c).to_numpy(zero_copy_only=False).astype("<i8").tobytes() for c in ("id", "label")]
                columns += [cell.tobytes(), m.astype("<i8").tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pid << 33 | seq[0]]), pa.array([part.num_rows], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)], names=["block", "n", "id", "label", "cell", "exact"]
                )
                seq[0] += 1

        return run

    blocks = arrow_map(vectors, ["id", "label", "vector"], "block long, n int, id binary, label binary, cell binary, exact binary", pack)
    return Approximation(materialise(blocks, "approximation"), low, step, rows)


class Anchors:
    """Anchors of a task, their look-up tables, and the best rows of each of their windows so far."""

    def __init__(self, made: list[tuple], low: np.ndarray, step: np.ndarray, keep: int, same: bool):
        self.key, self.id, self.label = (np.array([a[i] for a in made], np.int64) for i in range(3))
        self.vector = np.array([a[3] for a in made], np.int64).reshape(len(made), len(low))
        windows = [a[4] for a in made]
        most = max(map(len, windows))
        #: (anchors, windows) of lowest and highest scores; where an anchor has fewer windows, none can be entered.
        self.least = np.array([[w[0] for w in ws] + [1] * (most - len(ws)) for ws in windows], np.int64)
        self.most = np.array([[w[1] for w in ws] + [0] * (most - len(ws)) for ws in windows], np.int64)
        self.keep, self.same = keep, same
        cells = low + step * np.arange(CELLS)[:, None]  # (cells, dimensions): the cells' least values
        largest = np.abs(np.stack([cells[0], cells[-1] + step])).max(0) if len(low) else np.zeros(0)
        kind = np.int32 if float(np.abs(self.vector).max(0, initial=0) @ largest) < 1 << 31 else np.int64
        #: (dimensions, cells, anchors): bounds of each product.
        self.under, self.over = (np.empty((len(low), CELLS, len(made)), kind) for _ in range(2))
        for d in range(len(low)):
            a, b = np.outer(cells[:, d], self.vector[:, d]), np.outer(cells[:, d] + step[d] - 1, self.vector[:, d])
            self.under[d], self.over[d] = np.minimum(a, b), np.maximum(a, b)
        shape = (*self.least.shape, keep)
        self.scores, self.ids = np.full(shape, -(1 << 62), np.int64), np.full(shape, 1 << 62, np.int64)
        self.filled = np.zeros(self.least.shape, np.int64)
        self.exact = 0

    def meet(self, ids: np.ndarray, labels: np.ndarray, cell: np.ndarray, exact: np.ndarray) -> None:
        """Takes a block's rows that enter a window."""
        under, over = (np.zeros((len(ids), len(self.id)), self.under.dtype) for _ in range(2))
        for d in range(cell.shape[1]):
            under += self.under[d][cell[:, d]]
            over += self.over[d][cell[:, d]]
        fits = labels[:, None] == self.label
        fits = fits & (ids[:, None] != self.id) if self.same else ~fits
        for w in range(self.least.shape[1]):
            least, most = self.least[:, w], self.most[:, w]
            may = fits & (over >= least) & (under <= most)
            # rows that surely lie in the window push up the score that another row needs
            sure = np.where(may & (under >= least) & (over <= most), under, -(1 << 62))
            need = self.scores[:, w, -1]
            if len(ids) >= self.keep:
                need = np.maximum(need, np.partition(sure, len(ids) - self.keep, axis=0)[len(ids) - self.keep])
            row, anchor = np.nonzero(may & (over >= need))
            if not len(row):
                continue
            score = np.einsum("ij,ij->i", exact[row], self.vector[anchor])
            self.exact += len(row)
            on = (score >= least[anchor]) & (score <= most[anchor]) & (score >= need[anchor])
            self._take(w, anchor[on], score[on], ids[row[on]])

    def _take(self, w: int, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -score, anchor))
        anchor, score, ids = anchor[order], score[order], ids[order]
        bounds = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True]) if len(anchor) else np.zeros(1, int)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            hi, a = min(hi, lo + self.keep), anchor[lo]
            s = np.concatenate([self.scores[a, w], score[lo:hi]])
            i = np.concatenate([self.ids[a, w], ids[lo:hi]])
            best = np.lexsort((i, -s))[: self.keep]
            self.scores[a, w], self.ids[a, w] = s[best], i[best]
            self.filled[a, w] = min(self.keep, self.filled[a, w] + hi - lo)

    def kept(self) -> pa.RecordBatch:
        a, w, k = np.nonzero(np.arange(self.keep) < self.filled[:, :, None])
        columns = [self.key[a], self.id[a], w.astype(np.int32), self.ids[a, w, k], self.scores[a, w, k]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "anchor_id", "nth", "id", "score"])


_FOUND = "anchor long, anchor_id long, nth int, id long, score long"


def search(file: Approximation, anchors: DataFrame, keep: int, same: bool) -> DataFrame:
    """(anchor, anchor_id, nth, id, score, rank): for each window of each anchor the best ``keep`` rows in it, of the
    anchor's label but for its own id (``same``), or of other labels; higher scores first, then smaller ids.
    ``anchors(anchor, id, label, vector, windows)``: ``anchor`` tells rows apart, windows are pairs of least and most score."""
    low, step = file.low, file.step
    n = anchors.count()
    buckets, groups = max(1, -(-n * max(1, len(low)) // ENTRIES)), max(1, -(-file.rows // (ROWS * BLOCKS)))
    at = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m))
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    asked = anchors.select(at("anchor", buckets).alias("bucket"), every(groups).alias("group"), F.lit(0).alias("kind"), F.struct("anchor", "id", "label", "vector", "windows").alias("asked"))
    blocks = file.blocks.select(at("block", groups).alias("group"), F.lit(1).alias("kind"), F.struct("n", "id", "label", "cell", "exact").alias("met"), every(buckets).alias("bucket"))
    both = asked.unionByName(blocks, allowMissingColumns=True)

    def run(batches):
        now, made, state = None, [], None
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("bucket", "group", "kind")), strict=True)
            for k, (bucket, group, kind) in enumerate(keys):
                if (bucket, group) != now:
                    if state:
                        yield state.kept()
                    now, made, state = (bucket, group), [], None
                if kind == 0:
                    a = batch.column("asked")[k].as_py()
                    made.append((a["anchor"], a["id"], a["label"], a["vector"] + [0] * (len(low) - len(a["vector"])), [(w["least"], w["most"]) for w in a["windows"]]))
                elif made:
                    state = state or Anchors(made, low, step, keep, same)
                    b = batch.column("met")[k].as_py()
                    wide = (b["n"], len(low))
                    state.meet(np.frombuffer(b["id"], "<i8"), np.frombuffer(b["label"], "<i8"), np.frombuffer(b["cell"], np.uint8).reshape(wide), np.frombuffer(b["exact"], "<i8").reshape(wide))
        if state:
            yield state.kept()

    reach(anchors.sparkSession)
    dealt = both.repartition(min(TASKS, buckets * groups), "bucket", "group").sortWithinPartitions("bucket", "group", "kind")
    found = dealt.mapInArrow(run, _FOUND)
    best = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: tuple[int, int] = LOWEST, highest: tuple[int, int] = HIGHEST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, the rows of
    ``vectors(id, label, vector)`` (integers) whose id ``every`` divides.

    Defined cases: rows that repeat an id are rows of their own, as anchors and as candidates, but a row of the anchor's id is
    never its positive; ties go to smaller ids; shorter vectors end in zeros; a positive of a negative score has an empty
    window; anchors without positives or negatives have no rows; an empty table gives none; components so large that a score
    might not fit in 64 bits are an error."""
    held = materialise(vectors.withColumn("anchor", F.monotonically_increasing_id()), "rows")
    file = approximation(held.select("id", "label", "vector"))
    anchors = held.where(F.col("id") % every == 0)
    whole = F.array(F.struct(F.lit(-(1 << 61)).alias("least"), F.lit(1 << 61).alias("most")))
    close = materialise(search(file, anchors.withColumn("windows", whole), positives, True), "positives")
    ordered = close.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))).alias("own"))  # at most ``positives``
    low, high = (f"p.positive_score * {a}" for a in (lowest[0], highest[0]))
    window = f"named_struct('least', ({low} + {lowest[1] - 1}) div {lowest[1]}, 'most', {high} div {highest[1]})"
    windows = F.expr(f"transform(own, p -> CASE WHEN p.positive_score < 0 THEN named_struct('least', 1L, 'most', 0L) ELSE {window} END)")
    asked = anchors.join(ordered, "anchor").withColumn("windows", windows)
    far = search(file, asked.select("anchor", "id", "label", "vector", "windows"), negatives, False)
    pairs = close.select("anchor", (F.col("rank") - 1).alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.select("anchor", "anchor_id", "nth", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(pairs, ["anchor", "nth"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("long").alias("rank"), "negative_id", "positive_score", "negative_score")
