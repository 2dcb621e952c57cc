"""Packing token sequences into bins of one size by a linear grouping scheme.

Lengths are integers up to the bin size, so the histogram of all pieces is at most that many numbers: the driver plans on
the histogram alone, and the plan's size depends on the bin size, never on the number of pieces.

1. Large lengths, in descending order, are cut into groups of equal cardinality and rounded up to their group's largest.
2. The few rounded sizes are packed by configurations from the cutting-stock linear programme (column generation: a
   knapsack prices new configurations, a dense simplex keeps the basis); whole multiples of each are taken.
3. The actual lengths of each group take the places of its rounded size, which leaves gaps.
4. What remains of the large lengths, then the small ones, longest first, go best-fit into the tightest gap.

Rounding can cost more than it gains where lengths differ much, so plans are made for several limits between large and
small lengths and several numbers of groups, and the one with the fewest sequences is taken; every plan goes through all
four steps. Plans cost the driver a few seconds at any number of pieces.

Executors then turn (length, rank among the pieces of this length) into (sequence, offset).
"""

from __future__ import annotations

import logging
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import arrow_map, materialise, utf8
from tamis.llm.tokens import tokenizer, vocabulary

log = logging.getLogger(__name__)

CAPACITY = 4096
#: Numbers of groups, and the parts of the capacity above which lengths are large, that plans are made for. Few groups leave
#: gaps that small lengths fill; above half the capacity a configuration holds one large length.
GROUPS, SMALL = (12, 48, 96, 192), (3, 4, 8, 16, 32, 64, 2)
#: A plan that needs at most this share of sequences more than all tokens fill is good enough; within the other share of the
#: best one, a limit is worth more groups.
NEAR, CLOSE = 0.001, 0.005
END_ID = 1


class Plan:
    """Placement intervals: ranks [lo, lo + n) of a length go, ``per`` to a sequence, to sequences from ``first`` on,
    at ``offset`` and further multiples of the length."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self.rank: dict[int, int] = {}
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.order: list[int] = []

    def place(self, length: int, n: int, first: int, offset: int, per: int = 1) -> None:
        lo = self.rank.get(length, 0)
        self.rows.append((length, lo, n, first, offset, per))
        self.rank[length] = lo + n

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def leave(self, gap: int, first: int, n: int) -> None:
        """Sequences [first, first + n) have ``gap`` tokens free."""
        if gap and n:
            if gap not in self.gaps:
                self.gaps[gap] = []
                insort(self.order, gap)
            self.gaps[gap].append((first, n))

    def best_fit(self, length: int, count: int) -> None:
        while count:
            at = bisect_left(self.order, length)
            if at == len(self.order):
                per = self.capacity // length
                bins = max(1, count // per)
                gap, first, n = self.capacity, self.new(bins), bins
            else:
                gap = self.order[at]
                first, n = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                    self.order.pop(at)
            per = min(gap // length, count)
            bins = min(n, count // per)
            self.place(length, bins * per, first, self.capacity - gap, per)
            self.leave(gap, first + bins, n - bins)
            self.leave(gap - per * length, first, bins)
            count -= bins * per

    def arrays(self) -> dict[str, np.ndarray]:
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 6)
        return dict(zip(("length", "lo", "n", "first", "offset", "per"), rows.T.copy(), strict=True))


def _groups(counts: np.ndarray, least: int, groups: int) -> list[list[tuple[int, int]]]:
    """Runs (length, count), longest first, of each of at most ``groups`` groups of equal cardinality."""
    total = int(counts[least:].sum())
    quota = -(-total // groups) if total else 0
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length in range(len(counts) - 1, least - 1, -1):
        left = int(counts[length])
        while left:
            if not room:
                out.append([])
                room = quota
            take = min(left, room)
            out[-1].append((length, take))
            left -= take
            room -= take
    merged: list[list[tuple[int, int]]] = []
    for runs in out:
        if merged and merged[-1][0][0] == runs[0][0]:
            merged[-1] += runs
        else:
            merged.append(runs)
    return merged


def _dearest(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """(copies of each size, value) of the configuration worth most: an unbounded knapsack, over as many capacities at once
    as the smallest size allows."""
    least = int(sizes.min())
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for lo in range(least, capacity + 1, least):
        at = np.arange(lo, min(lo + least, capacity + 1))
        before = at[:, None] - sizes
        offer = np.where(before >= 0, best[np.maximum(before, 0)] + price, 0.0)
        i = offer.argmax(1)
        best[at] = offer[np.arange(len(at)), i]
        pick[at] = np.where(best[at] > 0, i, -1)
    copies, room = np.zeros(len(sizes)), capacity
    while pick[room] >= 0:
        copies[pick[room]] += 1
        room -= int(sizes[pick[room]])
    return copies, float(best[capacity])


def configurations(sizes: list[int], demand: list[int], capacity: int, slack: float = 0.5) -> list[tuple[list[int], int]]:
    """(copies of each size, whole multiples) of configurations; together at most ``demand``.

    The linear programme runs until its value is within ``slack`` sequences of Farley's lower bound. Where degenerate steps
    stop making progress before that, which a warning reports, the plan is right but may need a few sequences more."""
    k, at = len(sizes), np.array(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    value, stuck = need / np.diag(basis), 0
    while True:
        price = np.linalg.solve(basis.T, np.ones(k))
        column, worth = _dearest(at, np.maximum(price, 0.0), capacity)
        if worth <= 1 + 1e-9 or value.sum() * (1 - 1 / worth) < slack:
            break
        step = np.linalg.solve(basis, column)
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.where(up, np.maximum(value, 0) / np.where(up, step, 1), np.inf)
        out = int(np.argmin(ratio))
        stuck = stuck + 1 if ratio[out] <= 1e-12 else 0
        if stuck > 10 * k:
            log.warning("configurations of %d sizes: no progress, %.1f sequences above the bound", k, value.sum() * (1 - 1 / worth))
            break
        basis[:, out] = column
        value = np.linalg.solve(basis, need)
    left, out = [int(d) for d in demand], []
    for j in np.argsort(-value):
        copies = [int(round(c)) for c in basis[:, j]]
        times = max(0, int(value[j] + 1e-6))
        times = min([times, *(left[i] // c for i, c in enumerate(copies) if c)])
        if times:
            left = [n - c * times for n, c in zip(left, copies, strict=True)]
            out.append((copies, times))
    return out


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> Plan:
    """A plan for ``counts[length]`` pieces of each length up to ``capacity``: of the scheme with each limit between small and
    large lengths, the one of the fewest sequences, the first of those. Where no length is above the least limit, those above
    half the longest are large, so that there is always something to group. A limit is tried with the two fewest numbers of groups
    first, and with more only while that comes within ``CLOSE`` of the best plan, which even lengths do and lengths of all sizes do not.
    Every limit is tried with the fewest groups unless a plan meets the bound that all tokens set; the search ends within
    ``NEAR`` of it."""
    counts = np.asarray(counts, np.int64)
    least = -(-int((np.arange(len(counts)) * counts).sum()) // capacity)
    longest = int(np.flatnonzero(counts).max(initial=0))
    limits = [small for small in SMALL if longest > capacity // small] or [2 * capacity // max(longest, 1)]
    best, tried = None, set()
    for n in groups:
        found = {}
        for small in limits:
            runs = tuple(r[0][0] for r in _groups(counts, capacity // small + 1, n))
            if runs not in tried and (best is None or best.sequences > least * (1 if n == groups[0] else 1 + NEAR)):
                tried.add(runs)
                found[small] = grouped_plan(counts, capacity, n, small)
                best = min(best or found[small], found[small], key=lambda p: p.sequences)
        if n != groups[0]:
            limits = [small for small, p in found.items() if p.sequences <= best.sequences * (1 + CLOSE)]
    return best


def grouped_plan(counts: np.ndarray, capacity: int, groups: int, small: int) -> Plan:
    """The linear grouping scheme, lengths above capacity / ``small`` being large."""
    plan = Plan(capacity)
    least = capacity // small + 1
    runs = _groups(np.asarray(counts, np.int64), least, groups)
    sizes = [r[0][0] for r in runs]
    supply = [[list(x) for x in r] for r in runs]
    used = configurations(sizes, [sum(n for _, n in r) for r in runs], capacity) if runs else []
    for copies, times in used:
        first = plan.new(times)
        bins = [(first, times, 0)]
        for i, c in enumerate(copies):
            for _ in range(c):
                filled = []
                for start, n, fill in bins:
                    while n:
                        length, there = supply[i][0]
                        take = min(n, there)
                        plan.place(length, take, start, fill)
                        filled.append((start, take, fill + length))
                        start, n = start + take, n - take
                        supply[i][0][1] -= take
                        if not supply[i][0][1]:
                            supply[i].pop(0)
                bins = filled
        for start, n, fill in bins:
            plan.leave(capacity - fill, start, n)
    rest: dict[int, int] = {}
    for r in supply:
        for length, n in r:
            rest[length] = rest.get(length, 0) + n
    for length in sorted(rest, reverse=True):
        plan.best_fit(length, rest[length])
    for length in range(min(least, len(counts)) - 1, 0, -1):
        plan.best_fit(length, int(counts[length]))
    return plan


def token_pieces(docs: DataFrame, vocab: str, capacity: int, id_col: str, text_col: str, carry: tuple = ()) -> DataFrame:
    """A row for each piece, with the task that made it (``pid``) and its rank there among pieces of its length."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(id_col, *carry).schema)
    kept = [id_col, *carry]

    def make():
        model = tokenizer(vocab)
        seen = np.zeros(capacity + 1, np.int64)
        pid = TaskContext.get().partitionId()
        end = END_ID.to_bytes(4, "little")

        def step(batch):
            at, piece, start, length, crc, nth = [], [], [], [], [], []
            for k, ids in enumerate(model.encode(utf8(batch, text_col))):
                ids += end
                for p, lo in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[lo : lo + 4 * capacity]
                    n = len(part) // 4
                    at.append(k)
                    piece.append(p)
                    start.append(lo // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    nth.append(seen[n])
                    seen[n] += 1
            rows = pa.array(at, pa.int64())
            own = [batch.column(c).take(rows) for c in kept]
            new = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)), pa.array([pid] * len(at), pa.int32()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(own + new, names=[*kept, "piece", "start", "length", "ids_crc32", "pid", "nth"])

        return step

    columns = list(dict.fromkeys([*kept, text_col]))
    return arrow_map(docs, columns, f"{kinds}, piece int, start long, length long, ids_crc32 long, pid int, nth long", make)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocab: str | None = None,
    capacity: int = CAPACITY,
    groups: tuple[int, ...] = GROUPS,
    carry: tuple = (),
) -> DataFrame:
    """Every document's pieces with their ``sequence_id`` and ``offset``.

    Defined cases: a null or empty text is one piece holding the end id alone; only texts of more than ``capacity`` ids
    are cut; null ids and repeated rows are packed like others; an empty table gives no rows. ``carry`` names further
    columns to keep; other columns are left aside.
    """
    pieces = materialise(token_pieces(docs, vocab or vocabulary(), capacity, id_col, text_col, carry), "pieces")
    tally = materialise(pieces.groupBy("pid", "length").count(), "tally")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in tally.groupBy("length").agg(F.sum("count")).collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = plan_packing(counts, capacity, groups).arrays()
    before = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    base = tally.select("pid", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base.hint("merge"), ["pid", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    out = [id_col, *carry, "piece", "start", "length", "ids_crc32"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.select(*out).schema)
    stride = np.int64(1) << 44

    def make():
        starts = plan["length"] * stride + plan["lo"]

        def step(batch):
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(starts, length * stride + rank, side="right") - 1
            nth, per = rank - plan["lo"][at], plan["per"][at]
            seq = plan["first"][at] + nth // per
            offset = plan["offset"][at] + nth % per * length
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in out] + [pa.array(seq), pa.array(offset)], names=[*out, "sequence_id", "offset"])

        return step

    return arrow_map(ranked, [*out, "rank"], f"{kinds}, sequence_id long, offset long", make)
