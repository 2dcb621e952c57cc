"""Byte-level BPE: texts to token ids and back, by a segment tree over byte positions.

A text is split by the vocabulary's pattern; each match is merged on its own. Leaf i of the tree holds the rank of the
pair that starts at byte position i together with i itself, or nothing where no token starts or no merge is known, and each
inner node the least of its two children: the root is the leftmost pair of the lowest rank. A merge takes the right token
out of a linked list of live positions and changes three leaves (the merged token's, its left neighbour's and the one that
died), each in logarithmic time, so a match of n bytes costs n log n whatever its length.

Short matches take their merges in rounds, many trees at once, in arrays; long ones go one by one.
Matches and the parts of a text between single spaces are remembered in each Python worker, in caches of a fixed number of
entries, so the tree runs once for each distinct match while the cache holds it.
"""

from __future__ import annotations

import base64
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import arrow_map, texts
from tamis.llm.tokens import vocabulary

#: Entries of each cache, and characters of the longest text part it keeps; a full cache is emptied, which costs time and
#: changes no result.
CACHE_ENTRIES, LONGEST = 600_000, 256
#: Bytes of a match that is merged along with others.
SHORT = 64
#: A single space between two other characters: no match of a pattern whose words may start with a space crosses it.
_SEAM = re.compile(r"(?<=\S) (?=\S)")
_SHIFT = 32
_NONE = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """(left id << 32 | right id) of each pair of tokens that together make a token, and that token's id."""
    out = {}
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                out[left << _SHIFT | right] = rank
    return out


def merge(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """The ids left once no two neighbours of ``ids`` have a rank, the leftmost pair of the lowest rank merged first."""
    n = len(ids)
    if n < 2:
        return ids
    ids = list(ids)
    size = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        rank = pairs.get(ids[i] << _SHIFT | ids[i + 1])
        if rank is not None:
            tree[size + i] = rank << _SHIFT | i
    for at in range(size - 1, 0, -1):
        a, b = tree[2 * at], tree[2 * at + 1]
        tree[at] = a if a <= b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    get = pairs.get
    while tree[1] != _NONE:
        i = tree[1] & 0xFFFFFFFF
        ids[i] = tree[1] >> _SHIFT
        dead = after[i]
        right = after[i] = after[dead]
        rank = None
        if right < n:
            before[right] = i
            rank = get(ids[i] << _SHIFT | ids[right])
        leaves = [(dead, _NONE), (i, _NONE if rank is None else rank << _SHIFT | i)]
        left = before[i]
        if left >= 0:
            rank = get(ids[left] << _SHIFT | ids[i])
            leaves.append((left, _NONE if rank is None else rank << _SHIFT | left))
        for at, value in leaves:
            at += size
            while at and tree[at] != value:
                tree[at] = value
                at >>= 1
                a, b = tree[2 * at], tree[2 * at + 1]
                value = a if a <= b else b
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


class PairTable:
    """``pair_ranks`` as sorted arrays, for many look-ups at once."""

    def __init__(self, pairs: dict[int, int]):
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The tree's leaves at ``place`` for pairs of ids; an id below zero stands for no token."""
        key = left << _SHIFT | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at] << _SHIFT | place, _NONE)


def merge_many(ids: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """``merge`` of many rows at once: a row of ``ids`` ends in -1 where it is shorter. One tree for each row; a round takes
    the next merge of every row that has one. The rows' ids in the same form, with gaps, and which places are live."""
    m, n = ids.shape
    size = 1 << max(n - 1, 1).bit_length()
    wide = np.full((m, size + 1), -1, np.int64)
    wide[:, :n] = ids
    tree = np.full((m, 2 * size), _NONE, np.int64)
    place = np.arange(size)
    tree[:, size:] = table.leaves(wide[:, :-1], wide[:, 1:], place[None, :])
    for low in (size >> k for k in range(1, size.bit_length())):
        tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
    after = np.broadcast_to(np.arange(1, size + 2), (m, size + 1)).copy()
    after[:, size] = size
    before = np.broadcast_to(np.arange(-1, size), (m, size + 1)).copy()
    live = wide[:, :size] >= 0
    row = np.flatnonzero(tree[:, 1] != _NONE)
    while len(row):
        top = tree[row, 1]
        i = top & 0xFFFFFFFF
        own = wide[row, i] = top >> _SHIFT
        dead = after[row, i]
        right = after[row, dead]
        after[row, i] = right
        before[row, right] = i
        live[row, dead] = False
        wide[row, dead] = -1
        left = before[row, i]
        tree[row, size + dead] = _NONE
        tree[row, size + i] = table.leaves(own, wide[row, right], i)
        some = left >= 0
        tree[row[some], size + left[some]] = table.leaves(wide[row[some], left[some]], own[some], left[some])
        for r, at in ((row, size + dead), (row, size + i), (row[some], size + left[some])):
            for _ in range(size.bit_length() - 1):
                at = at >> 1
                tree[r, at] = np.minimum(tree[r, 2 * at], tree[r, 2 * at + 1])
        row = row[tree[row, 1] != _NONE]
    return wide[:, :size], live


class ByteBpe:
    """``encode`` gives texts' ids, ``decode`` the bytes of ids."""

    def __init__(self, path: str, pattern: str, entries: int = CACHE_ENTRIES):
        import regex

        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pairs = pair_ranks(self.ranks)
        self.table = PairTable(self.pairs)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{path}: no token for the bytes {missing}")
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.matches = regex.compile(pattern).findall
        #: Whether parts between single spaces stand alone, which holds for patterns whose words may begin with one space.
        self.seams = " ?" in pattern
        #: Whether letters alone are one match.
        self.words = r" ?\p{L}+" in pattern
        self.entries = entries
        self.parts: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def merged(self, found: set[str]) -> dict[str, bytes]:
        """The packed ids of matches: tokens at once, short matches by many trees at once, long ones one by one."""
        out: dict[str, bytes] = {}
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for match in found:
            raw = match.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[match] = whole.to_bytes(4, "little")
            elif len(raw) <= SHORT:
                classes.setdefault((len(raw) - 1).bit_length(), []).append((match, raw))
            else:
                ids = merge([self.single[b] for b in raw], self.pairs)
                out[match] = struct.pack(f"<{len(ids)}I", *ids)
        single = np.array([*self.single, -1], np.int64)
        for bits, rows in classes.items():
            for lo in range(0, len(rows), 4096):
                some = rows[lo : lo + 4096]
                counts = np.array([len(raw) for _, raw in some])
                octets = np.full((len(some), 1 << bits), 256)
                octets[np.arange(1 << bits) < counts[:, None]] = np.frombuffer(b"".join(raw for _, raw in some), np.uint8)
                ids, live = merge_many(single[octets], self.table)
                packed = ids[live].astype("<u4").tobytes()
                ends = 4 * live.sum(1).cumsum()
                start = 0
                for (match, _), end in zip(some, ends.tolist(), strict=True):
                    out[match] = packed[start:end]
                    start = end
        return out

    def _split(self, part: str) -> list[str]:
        return [f" {part}"] if self.words and part.isascii() and part.isalpha() else self.matches(f" {part}")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; no string in a text is a special token."""
        split = [_SEAM.split(t) if self.seams else [t] for t in texts]
        known, pieces = self.parts, self.pieces
        first = [self.matches(parts[0]) for parts in split]
        new = {p: self._split(p) for p in {p for parts in split for p in parts[1:] if p not in known}}
        wanted = {m for matches in first for m in matches if m not in pieces}
        wanted.update(m for matches in new.values() for m in matches if m not in pieces)
        fresh = self.merged(wanted)
        ids_of = lambda m: fresh[m] if m in fresh else pieces[m]
        learnt = {p: b"".join(map(ids_of, matches)) for p, matches in new.items()}
        out = []
        for parts, matches in zip(split, first, strict=True):
            rest = list(map(known.get, parts[1:]))
            if None in rest:
                rest = [learnt[p] if ids is None else ids for p, ids in zip(parts[1:], rest, strict=True)]
            out.append(b"".join([*map(ids_of, matches), *rest]))
        self._keep(known, learnt, self.entries)
        self._keep(pieces, fresh, self.entries // 2)
        return out

    def _keep(self, cache: dict[str, bytes], more: dict[str, bytes], most: int) -> None:
        if len(cache) + len(more) > most:
            cache.clear()
        if len(more) <= most:
            cache.update((k, v) for k, v in more.items() if len(k) <= LONGEST)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that packed ids stand for; an id outside the vocabulary is an error."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def standard_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> ByteBpe:
    """One for each vocabulary and Python worker."""
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens, ids) of every whole text; ``ids`` packs little-endian unsigned 32-bit integers.

    Defined cases: a null or empty text has no ids; texts and matches of any length are taken whole; null ids and repeated
    rows stay, each with its own row; an empty table gives no rows; other columns are left aside, whatever their names.
    ``vocab`` must be readable at the same path on every executor."""
    path, pattern = vocab or vocabulary("byte_bpe_50k.tiktoken"), pattern or standard_pattern()
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        model = coder(path, pattern)

        def step(batch):
            ids = model.encode(texts(batch, "text"))
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), counts, pa.array(ids, pa.binary())], names=["id", "n_tokens", "ids"])

        return step

    out = arrow_map(docs, [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")], f"id {kind}, n_tokens long, ids binary", make)
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", vocab: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its packed ids (of UTF-8, where the ids are those of a whole text).

    Defined cases: null or empty ids decode to no bytes; an id that the vocabulary lacks, or bytes that are no whole number
    of ids, fail; a column called ``decoded`` is replaced."""
    path, pattern = vocab or vocabulary("byte_bpe_50k.tiktoken"), pattern or standard_pattern()
    kept = encoded.drop("decoded")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def make():
        model = coder(path, pattern)

        def step(batch):
            got = [model.decode(i or b"") for i in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], names=[*batch.schema.names, "decoded"])

        return step

    return arrow_map(kept, kept.columns, f"{kinds}, decoded binary", make)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and its ids decoded again."""
    both = decode(encode(docs))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
