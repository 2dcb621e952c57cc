"""Benchmark passages in documents, by edit distance over words.

An item of n words is found where some run of a document's words is within ``edits(n)`` word insertions, deletions and
replacements of it (a fifth of its words at most). Words are lower-case runs of word characters.

* The CGK embedding (Chakraborty, Goldenberg, Koucky, STOC 2016) walks along a window: at step t it emits the word it
  stands on, then moves on or stays by a random bit of (t, word). Near windows fall into step again after an edit, so
  edit distance becomes Hamming distance over the steps.
* Bit sampling: each of ``REPEATS`` walks keeps ``SAMPLES`` steps as a key. An index of all items' keys is asked with the
  keys of a document's item-sized windows; items of any equal key become candidates, and the repetitions bring recall to
  its target. Items of more than ``PART`` words have windows of that size, every half of it, and each finds the whole item.
* Windows that cannot hold an item need no walk: with k edits in n words, one of the k + 1 untouched runs has at least
  (n - k) / (k + 1) >= 3 words while k <= (n - 3) / 4, so a window begins a known distance before three words in a row of
  some item (all words of an item of one or two). This rules nothing out; which item a window may hold is for its keys to say.
* Candidates are verified exactly, over the whole item, by Myers' bit-parallel algorithm, which also gives the passage's ends.

The items are a stated query set: their texts go to the executors in broadcast blocks of at most ``BLOCK_BYTES`` or one item,
one pass over the documents each, so that what is sent has a bound; each Python worker makes its index of a block once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tamis.llm.common import arrow_map, texts

WORD = re.compile(r"\w+")
REPEATS = 40
SAMPLES = 2
BLOCK_BYTES = 8 << 20
PART = 128
_SEED = 3
_BATCH = 4096
_MASKS = 20_000
#: Items of one key beyond which a window first looks at their words.
MANY = 64


def edits(n: int) -> int:
    """Word edits allowed for an item of n words."""
    return min(n // 5, max(0, (n - 3) // 4))


class Items:
    """A block of benchmark items: word ids, their runs of words, and an index of walk keys."""

    def __init__(self, rows: list[tuple[object, str]]):
        self.vocab: dict[str, int] = {}
        self.ids, self.seqs = [], []
        for item, text in rows:
            found = [w.lower() for w in WORD.findall(text or "")]
            if found:
                self.ids.append(item)
                self.seqs.append(np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in found], np.int64))
        self.base = len(self.vocab) + 1
        self.sizes = np.array([len(s) for s in self.seqs], np.int64)
        parts = [(k, at) for k, s in enumerate(self.seqs) for at in range(0, max(1, len(s) - PART // 2), PART // 2)]
        self.part_item = np.array([p[0] for p in parts], np.int64)
        self.part_at = np.array([p[1] for p in parts], np.int64)
        self.part_size = np.minimum(self.sizes[self.part_item] - self.part_at, PART) if parts else np.zeros(0, np.int64)
        grid = np.full((len(parts), int(self.part_size.max(initial=1))), -1, np.int64)
        for p, (k, at) in enumerate(parts):
            grid[p, : self.part_size[p]] = self.seqs[k][at : at + PART]
        #: Word ids of the items that are one part; longer ones have none here.
        self.grid, self.whole = grid, self.sizes <= PART
        self.first = np.searchsorted(self.part_item, np.arange(len(self.seqs)))
        self.runs = self._runs(grid)
        self.steps = 2 * int(self.part_size.max(initial=0))
        keys = [self.walk_keys(grid, self.part_size, r) for r in range(REPEATS)]
        self.order = [np.argsort(k, kind="stable").astype(np.int32) for k in keys]
        self.keys = [k[o] for k, o in zip(keys, self.order, strict=True)]
        self._masks: dict[tuple[int, bool], dict[int, int]] = {}

    def codes(self, ids: np.ndarray, width: int) -> np.ndarray:
        """A number for each ``width`` words in a row along the last axis; -1 where one is not a benchmark word."""
        n = ids.shape[-1] - width + 1
        if n <= 0:
            return np.zeros((*ids.shape[:-1], 0), np.int64)
        out, known = np.zeros((*ids.shape[:-1], n), np.int64), np.ones((*ids.shape[:-1], n), bool)
        for i in range(width):
            word = ids[..., i : i + n]
            out, known = out * self.base + word, known & (word > 0)
        return np.where(known, out, -1)

    def _runs(self, grid: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For one, two and three words in a row: their codes, sorted, with place in the part and the part's size."""
        out = []
        for width in (1, 2, 3):
            own = self.part_size >= 3 if width == 3 else self.part_size == width
            codes = self.codes(grid[own], width)
            row, at = np.nonzero(codes >= 0)
            every = np.unique(np.stack([codes[row, at], at, self.part_size[own][row]]), axis=1)
            out.append((width, *every))
        return out

    def _bits(self, repeat: int) -> np.ndarray:
        """Random bits of (step, word) for one walk."""
        return np.random.default_rng([_SEED, repeat]).integers(0, 2, (self.steps + 1, 257), dtype=np.int8)

    def walk_keys(self, windows: np.ndarray, sizes: np.ndarray, repeat: int) -> np.ndarray:
        """A key of each row of word ids (padded with -1), and of its size, for one walk; a walk along n words lasts about
        2 n steps."""
        n, width = windows.shape
        at, row = np.zeros(n, np.int64), np.arange(n)
        share = np.random.default_rng([_SEED, repeat, 1]).random(SAMPLES)
        want = (share[None, :] * 2 * sizes[:, None] * 0.95).astype(np.int64)
        key = sizes.copy()
        bits = self._bits(repeat)
        for t in range(int(want.max(initial=-1)) + 1):
            word = np.where(at < sizes, windows[row, np.minimum(at, width - 1)], -1)
            for s in range(SAMPLES):
                key = np.where(want[:, s] == t, key * 1_000_003 + word + 2, key)
            at += bits[t, (word * 40503 >> 3) & 255]
        return key

    def windows(self, ids: np.ndarray) -> np.ndarray:
        """Distinct (start, size) of the windows that hold words in a row of some item at their place in it."""
        out = []
        for width, codes, place, size in self.runs:
            if not len(codes):
                continue
            own = self.codes(ids, width)
            lo = np.searchsorted(codes, own, side="left")
            hit = np.flatnonzero((lo < len(codes)) & (own >= 0))
            hit = hit[codes[lo[hit]] == own[hit]]
            if len(hit):
                counts = np.searchsorted(codes, own[hit], side="right") - lo[hit]
                seed = np.repeat(lo[hit] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
                out.append(np.stack([np.maximum(np.repeat(hit, counts) - place[seed], 0), size[seed]], axis=1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)

    def _share_words(self, ids: np.ndarray, item: np.ndarray, start: int) -> np.ndarray:
        """Which items may lie near a window by the words they share with its surroundings: within k edits of a passage, all
        but k of an item's words stand in it. This rules out no passage, only the many items that open alike."""
        n = self.sizes[item]
        most = np.minimum(n // 5, np.maximum(0, (n - 3) // 4))
        lo, hi = max(0, start - int(most.max())), start + int((n + 2 * most).max())
        there = np.zeros(self.base + 1, bool)
        there[ids[lo:hi]] = True
        there[[0, -1]] = False
        return ~self.whole[item] | (there[self.grid[self.first[item]]].sum(1) >= n - most)

    def candidates(self, found: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, int]]:
        """Distinct (document, item, start of the item) of the windows that have a key of the item."""
        which = np.concatenate([np.zeros(0, np.int64), *(np.full(len(w), i) for i, (_, _, w) in enumerate(found))])
        every = np.concatenate([np.zeros((0, 2), np.int64), *(w for _, _, w in found)])
        for lo in range(0, len(which), _BATCH):
            start, size = every[lo : lo + _BATCH].T
            grid = np.full((len(start), int(size.max())), -1, np.int64)
            for r, (i, a, n) in enumerate(zip(which[lo : lo + _BATCH].tolist(), start.tolist(), size.tolist(), strict=True)):
                part = found[i][1][a : a + n]
                grid[r, : len(part)] = part
            met, parts, fits = [np.zeros(0, np.int64)], len(self.part_item), {}
            for repeat in range(REPEATS):
                keys = self.walk_keys(grid, size, repeat)
                first = np.searchsorted(self.keys[repeat], keys, side="left")
                counts = np.searchsorted(self.keys[repeat], keys, side="right") - first
                many = np.flatnonzero(counts > MANY)
                for r in many.tolist():  # items that walk alike: those that share enough words
                    if r not in fits:
                        fits[r] = self._share_words(found[which[lo + r]][1], self.part_item, int(start[r]))
                    part = self.order[repeat][first[r] : first[r] + counts[r]]
                    met.append(r * parts + part[fits[r][part]])
                counts[many] = 0
                row = np.repeat(np.arange(len(keys)), counts)
                place = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(len(row))
                met.append(np.unique(row * parts + self.order[repeat][place]))
            row, part = np.divmod(np.unique(np.concatenate(met)), max(parts, 1))
            got = np.unique(np.stack([which[lo + row], self.part_item[part], np.maximum(start[row] - self.part_at[part], 0)], axis=1), axis=0)
            got = got[np.lexsort((got[:, 1], got[:, 2], got[:, 0]))]
            cuts = np.flatnonzero(np.r_[True, (got[1:, [0, 2]] != got[:-1, [0, 2]]).any(1), True]) if len(got) else np.zeros(1, np.int64)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                k, ids, _ = found[int(got[a, 0])]
                for c in range(a, b, _BATCH):
                    some = got[c : min(b, c + _BATCH), 1]
                    yield from ((k, int(i), int(got[a, 2])) for i in some[self._share_words(ids, some, int(got[a, 2]))])

    def _mask(self, item: int, back: bool) -> dict[int, int]:
        got = self._masks.get((item, back))
        if got is None:
            if len(self._masks) >= _MASKS:
                self._masks.clear()
            got = self._masks[item, back] = {}
            for i, w in enumerate(self.seqs[item][:: -1 if back else 1].tolist()):
                got[w] = got.get(w, 0) | (1 << i)
        return got

    def verify(self, ids: np.ndarray, item: int, start: int) -> tuple[int, int, int] | None:
        """(distance, first word, past the last word) of the best passage near a window, or None beyond the limit."""
        n = int(self.sizes[item])
        most = edits(n)
        lo, hi = max(0, start - most), min(len(ids), start + n + 2 * most)
        part = ids[lo:hi].tolist()
        best, end = _search(self._mask(item, False), n, part, free=True)
        if best > most:
            return None
        _, back = _search(self._mask(item, True), n, part[:end][::-1], free=False, stop=best)
        return best, lo + end - back, lo + end

    def search(self, some: list[str]) -> Iterator[tuple[int, int, tuple[int, int, int]]]:
        """(text, item, passage) of every candidate that holds."""
        ids_of, found = {}, []
        for k, text in enumerate(some):
            got = np.fromiter((self.vocab.get(w, 0) for w in map(str.lower, WORD.findall(text))), np.int64)
            windows = self.windows(got)
            if len(windows):
                ids_of[k] = got
                found.append((k, got, windows))
        exact = set()  # what is found without an edit cannot be found any better
        for k, item, start in self.candidates(found):
            if (k, item) in exact:
                continue
            held = self.verify(ids_of[k], item, start)
            if held:
                if not held[0]:
                    exact.add((k, item))
                yield k, item, held


class Block:
    """Items as they are sent: ids and texts. The index is made on first use, once in each worker."""

    def __init__(self, rows: list[tuple[object, str]]):
        self.rows = rows
        self._items: Items | None = None

    def __getstate__(self) -> dict:
        return {"rows": self.rows, "_items": None}

    @property
    def items(self) -> Items:
        if self._items is None:
            self._items = Items(self.rows)
        return self._items


def _search(mask: dict[int, int], m: int, text: list[int], free: bool, stop: int = -1) -> tuple[int, int]:
    """Least edit distance of a pattern to a run of ``text`` that ends at the returned place (Myers, JACM 1999);
    ``free`` lets the run start anywhere, else it starts at the first word."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text, 1):
        eq = mask.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ((ph << 1) | (0 if free else 1)) & full
        mh = (mh << 1) & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
        if score < best:
            best, end = score, j
            if best == stop:
                break
    return best, end


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items with an id and a text, in blocks, as they come to the driver a partition at a time."""
    rows = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
    some, size = [], 0
    for item, text in rows.select(item_col, text_col).distinct().toLocalIterator():
        if some and size + len(text.encode()) > most:
            yield Block(some)
            some, size = [], 0
        some.append((item, text))
        size += len(text.encode())
    yield Block(some)


def _search_block(docs: DataFrame, block: Block, id_col: str, text_col: str, item_kind) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def make():
        items = sent.value.items

        def step(batch):
            old = texts(batch, text_col)
            best: dict[tuple[int, object], tuple[int, int, int]] = {}
            for k, item, held in items.search(old):
                key = (k, items.ids[item])
                if key not in best or held < best[key]:
                    best[key] = held
            out: list[tuple] = []
            spans: dict[int, list] = {}
            for (k, item), (distance, a, b) in sorted(best.items()):
                at = spans.setdefault(k, [m.span() for m in WORD.finditer(old[k])])
                out.append((k, item, distance, at[a][0], at[b - 1][1]))
            rows = pa.array([r[0] for r in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(rows), pa.array([r[1] for r in out], own), *(pa.array([r[i] for r in out], pa.int64()) for i in (2, 3, 4))],
                names=[id_col, "item_id", "edits", "start", "end"],
            )

        return step

    kind, own = docs.schema[id_col].dataType.simpleString(), to_arrow_type(item_kind)
    return arrow_map(docs, [id_col, text_col], f"`{id_col}` {kind}, item_id {item_kind.simpleString()}, edits long, start long, end long", make)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and item it holds: ids, word ``edits`` of the best passage and its ``start`` and ``end``
    in code points.

    Ids are of any type that has an order; columns besides those named, and columns of equal names in both tables, play no
    part. Defined cases: null and empty texts hold nothing; items without an id or without a word match nothing, items of one
    word and of many thousands are found like others; repeated documents are each reported, repeated items (rows of one id)
    once, by the better; a null document id is reported as null; of equally near passages (ties) the first is given; texts
    of any length are searched whole; empty tables give no rows.
    """
    out = None
    for block in blocks(benchmark, item_col, most=block_bytes):
        part = _search_block(docs, block, id_col, text_col, benchmark.schema[item_col].dataType)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; the decision is each row's own, so nothing is joined
    for the first block of items and later blocks filter what it left. All columns stay. Null and empty texts hold nothing and
    stay; repeated rows stay or go together; which of equally near passages is found plays no part."""
    for block in blocks(benchmark, most=block_bytes):
        docs = _filter_block(docs, block, text_col)
    return docs


def _filter_block(docs: DataFrame, block: Block, text_col: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def make():
        items = sent.value.items

        def step(batch):
            bad = {k for k, _, _ in items.search(texts(batch, text_col))}
            yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)], pa.bool_())) if bad else batch

        return step

    return arrow_map(docs, docs.columns, docs.schema, make)
