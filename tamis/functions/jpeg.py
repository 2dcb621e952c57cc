"""Baseline JPEG of BGR images, in NumPy: colour transform, 8 x 8 cosine transform, quantisation and Huffman codes.

Blocks are transformed and quantised all at once; the symbols of all blocks become one bit string in array operations. Code
lengths are fitted to each image's own symbols.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np

#: The quantisation tables of the JPEG standard's Annex K, in rows.
LUMA = (
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
)
CHROMA = (
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99,
)
_K = np.arange(8)
#: The orthonormal cosine transform of eight values.
_COSINES = np.sqrt(np.where(_K == 0, 1, 2) / 8)[:, None] * np.cos((2 * _K + 1) * _K[:, None] * np.pi / 16)
#: Places of a block in the order of its diagonals, each walked against the last one.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))


def quantisers(quality: int) -> tuple[np.ndarray, np.ndarray]:
    """The two tables for a quality of 1 to 100."""
    if not 1 <= quality <= 100:
        raise ValueError("a quality of 1 to 100")
    share = 5000 // quality if quality < 50 else 200 - 2 * quality
    return tuple(np.clip((np.array(t) * share + 50) // 100, 1, 255) for t in (LUMA, CHROMA))


def _planes(bgr: np.ndarray) -> list[np.ndarray]:
    b, g, r = (bgr[..., i].astype(float) for i in range(3))
    y = 0.299 * r + 0.587 * g + 0.114 * b
    return [y - 128, (b - y) / 1.772, (r - y) / 1.402]


def _padded(plane: np.ndarray, h: int, w: int) -> np.ndarray:
    return np.pad(plane, ((0, h - plane.shape[0]), (0, w - plane.shape[1])), mode="edge")


def _blocks(plane: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(rows, columns, 64) quantised coefficients of a plane's blocks, in zigzag order."""
    h, w = plane.shape
    parts = plane.reshape(h // 8, 8, w // 8, 8).swapaxes(1, 2)
    turned = _COSINES @ parts @ _COSINES.T
    return np.rint(turned.reshape(h // 8, w // 8, 64) / table)[..., ZIGZAG].astype(np.int64)


def code_lengths(counts: Counter, most: int = 16) -> dict[int, int]:
    """Huffman code lengths of at most ``most`` bits that leave the code of all ones unused."""
    heap = [(n, k, (s,)) for k, (s, n) in enumerate(sorted(counts.items()))] + [(0, -1, (None,))]
    heapq.heapify(heap)
    depth = Counter()
    k = len(heap)
    while len(heap) > 1:
        (n, _, a), (m, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        depth.update(a + b)
        heapq.heappush(heap, (n + m, k, a + b))
        k += 1
    at = Counter(depth.values())
    for d in range(max(at), most, -1):  # pairs that are too deep move up: one leaf above takes two places below it
        while at[d]:
            up = d - 2
            while not at[up]:
                up -= 1
            at[d] -= 2
            at[d - 1] += 1
            at[up + 1] += 2
            at[up] -= 1
    order = sorted((s for s in depth if s is not None), key=lambda s: (depth[s], s))
    places = [d for d in sorted(at) for _ in range(at[d])]
    return dict(zip(order, places, strict=False))  # the longest place is the unused one's


def _canonical(lengths: dict[int, int]) -> dict[int, int]:
    out, code, last = {}, 0, 0
    for s, d in sorted(lengths.items(), key=lambda x: (x[1], x[0])):
        code <<= d - last
        out[s], last = code, d
        code += 1
    return out


def _size(values: np.ndarray) -> np.ndarray:
    """Bits of the magnitude."""
    return np.where(values == 0, 0, np.floor(np.log2(np.maximum(np.abs(values), 1))).astype(np.int64) + 1)


def _symbols(blocks: np.ndarray, previous: np.ndarray) -> tuple[np.ndarray, ...]:
    """(block, place, is_dc, symbol, extra bits, their number) of blocks in scan order; ``previous`` holds each block's
    predecessor's first coefficient."""
    n = len(blocks)
    diff = blocks[:, 0] - previous
    size = _size(diff)
    every = [(np.arange(n), np.zeros(n, np.int64), np.ones(n, bool), size, np.where(diff < 0, diff + (1 << size) - 1, diff), size)]
    at, place = np.nonzero(blocks[:, 1:])
    place = place + 1
    value = blocks[at, place]
    first = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
    run = place - np.where(first, 0, np.r_[0, place[:-1]]) - 1 if len(at) else place
    size = _size(value)
    every.append((at, place * 8 + 7, np.zeros(len(at), bool), run % 16 * 16 + size, np.where(value < 0, value + (1 << size) - 1, value), size))
    for k in range(1, 4):  # sixteen zeros in a row
        on = run >= 16 * k
        m = int(on.sum())
        every.append((at[on], place[on] * 8 + k, np.zeros(m, bool), np.full(m, 0xF0), np.zeros(m, np.int64), np.zeros(m, np.int64)))
    ends = np.flatnonzero(blocks[:, 63] == 0)
    every.append((ends, np.full(len(ends), 64 * 8), np.zeros(len(ends), bool), np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)))
    return tuple(np.concatenate(x) for x in zip(*every, strict=True))


def _segment(mark: int, body: bytes) -> bytes:
    return bytes([0xFF, mark]) + (len(body) + 2).to_bytes(2, "big") + body


def encode(bgr: np.ndarray, quality: int = 95, halved: bool = True) -> bytes:
    """The image as a JPEG file; ``halved`` keeps colour at half the resolution on either axis."""
    h, w = bgr.shape[:2]
    if not 0 < min(h, w) <= max(h, w) < 1 << 16:
        raise ValueError("sides of 1 to 65,535 pixels")
    step = 2 if halved else 1
    tables = quantisers(quality)
    high, wide = -(-h // (8 * step)) * 8 * step, -(-w // (8 * step)) * 8 * step
    luma, *colour = (_padded(p, high, wide) for p in _planes(bgr))
    if halved:
        colour = [p.reshape(high // 2, 2, wide // 2, 2).mean((1, 3)) for p in colour]
    y = _blocks(luma, tables[0])
    rows, columns = high // (8 * step), wide // (8 * step)
    y = y.reshape(rows, step, columns, step, 64).swapaxes(1, 2).reshape(rows * columns, step * step, 64)
    units = np.concatenate([y, *(_blocks(p, tables[1]).reshape(rows * columns, 1, 64) for p in colour)], axis=1)
    each = units.shape[1]
    previous = np.zeros((rows * columns, each), np.int64)
    flat = y[..., 0].ravel()
    previous[:, : each - 2] = np.r_[0, flat[:-1]].reshape(rows * columns, -1)
    for c in (each - 2, each - 1):
        previous[1:, c] = units[:-1, c, 0]
    at, place, is_dc, symbol, extra, bits = _symbols(units.reshape(-1, 64), previous.ravel())
    kind = np.where(at % each < each - 2, 0, 1)
    code, length = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    huffman = b""
    for dc in (True, False):
        for k in (0, 1):
            on = (is_dc == dc) & (kind == k)
            lengths = code_lengths(Counter(symbol[on].tolist()))
            codes = _canonical(lengths)
            to_code, to_length = (np.zeros(256, np.int64) for _ in range(2))
            for s in codes:
                to_code[s], to_length[s] = codes[s], lengths[s]
            code[on], length[on] = to_code[symbol[on]], to_length[symbol[on]]
            per = Counter(lengths.values())
            listed = sorted(lengths, key=lambda s: (lengths[s], s))
            huffman += _segment(0xC4, bytes([(0 if dc else 16) + k, *(per[d] for d in range(1, 17)), *listed]))
    order = np.lexsort((place, at))
    total = (length + bits)[order]
    value = (code << bits | extra)[order]
    ends = np.cumsum(total)
    bit = np.arange(int(ends[-1])) - np.repeat(ends - total, total)
    stream = (np.repeat(value, total) >> (np.repeat(total, total) - 1 - bit)) & 1
    stream = np.r_[stream, np.ones(-len(stream) % 8, np.int64)]
    scan = np.packbits(stream.astype(np.uint8)).tobytes().replace(b"\xff", b"\xff\x00")
    sampling = 0x22 if halved else 0x11
    frame = bytes([8]) + h.to_bytes(2, "big") + w.to_bytes(2, "big") + bytes([3, 1, sampling, 0, 2, 0x11, 1, 3, 0x11, 1])
    quant = b"".join(_segment(0xDB, bytes([k]) + t[ZIGZAG].astype(np.uint8).tobytes()) for k, t in enumerate(tables))
    head = b"\xff\xd8" + _segment(0xE0, b"JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00") + quant
    return head + _segment(0xC0, frame) + huffman + _segment(0xDA, bytes([3, 1, 0, 2, 0x11, 3, 0x11, 0, 63, 0])) + scan + b"\xff\xd9"
