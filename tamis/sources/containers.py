"""Where the frames of raw videos lie, so that one file is read by many tasks.

An index tells each frame's place and length: frames of one size lie at a fixed stride (PPM images in a row, Y4M), the
table ``idx1`` lists those of an AVI file, and PPM images of several sizes are walked by their headers. Only headers and
tables are read for it. A torn last frame is none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

#: Bytes within which an image's or a stream's header ends.
HEADER = 4096
PPM = re.compile(rb"P6\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s")


@dataclass
class Index:
    """Frames of a file: ``n`` at ``first`` and every ``stride`` bytes, or at ``places`` of ``lengths`` bytes."""

    kind: str
    height: int
    width: int
    n: int
    first: int = 0
    stride: int = 0
    length: int = 0
    places: list[tuple[int, int]] = field(default_factory=list)
    fps: float | None = None
    #: What a Y4M frame's samples are, whether an AVI frame's rows go upwards, or the header of each PPM image.
    detail: object = None

    def part(self, lo: int, hi: int) -> Index:
        """The frames ``lo`` to ``hi``, as a task needs them."""
        if self.places:
            return Index(self.kind, self.height, self.width, hi - lo, places=self.places[lo:hi], fps=self.fps, detail=self.detail)
        return Index(self.kind, self.height, self.width, hi - lo, self.first + lo * self.stride, self.stride, self.length, fps=self.fps, detail=self.detail)

    def place(self, k: int) -> tuple[int, int]:
        return self.places[k] if self.places else (self.first + k * self.stride, self.length)

    def parts(self, most: int) -> list[tuple[int, int]]:
        """Ranges of frames of about ``most`` bytes each."""
        size = self.stride or max(1, sum(n for _, n in self.places) // max(1, self.n))
        each = max(1, most // size)
        return [(lo, min(lo + each, self.n)) for lo in range(0, self.n, each)]


def _at(file, place: int, n: int) -> bytes:
    file.seek(place)
    return file.read(n)


def index(file, size: int, most: int) -> Index:
    """The index of an open file of ``size`` bytes that is to be read in parts of ``most`` bytes."""
    head = _at(file, 0, min(size, HEADER))
    if head.startswith(b"YUV4MPEG2"):
        return _y4m(head, size)
    if head[:4] == b"RIFF" and head[8:12] == b"AVI ":
        return _avi(file, size)
    return _ppm(file, head, size, most)


def _ppm(file, head: bytes, size: int, most: int) -> Index:
    m = PPM.match(head)
    if not m or int(m[3]) != 255:
        return Index("ppm", 0, 0, 0)
    w, h = int(m[1]), int(m[2])
    stride = m.end() + 3 * w * h
    out = Index("ppm", h, w, size // stride, 0, stride, stride, detail=head[: m.end()])
    tail = size - out.n * stride
    edges = [*(lo for lo, _ in out.parts(most)), *([out.n] if tail else [])]
    own = head[: m.end()]
    if all(_at(file, k * stride, min(len(own), size - k * stride)) == own[: size - k * stride] for k in edges):
        return out
    return walked(file, size)


def walked(file, size: int) -> Index:
    """The index of PPM images of any sizes, from their headers in turn."""
    places, at, first = [], 0, None
    while at < size:
        m = PPM.match(_at(file, at, min(HEADER, size - at)))
        if not m or int(m[3]) != 255:
            break
        n = m.end() + 3 * int(m[1]) * int(m[2])
        if at + n > size:
            break
        first = first or m
        places.append((at, n))
        at += n
    return Index("ppm", int(first[2]) if first else 0, int(first[1]) if first else 0, len(places), places=places)


#: Samples of a chroma plane to those of the luma plane, across and down, by the name of a Y4M colour space.
CHROMA = {"mono": None, "444": (1, 1), "422": (2, 1), "420": (2, 2), "420jpeg": (2, 2), "420mpeg2": (2, 2), "420paldv": (2, 2)}


def _y4m(head: bytes, size: int) -> Index:
    line = head.split(b"\n", 1)[0]
    fields = {x[:1]: x[1:].decode() for x in line.split()[1:]}
    w, h, colour = int(fields[b"W"]), int(fields[b"H"]), fields.get(b"C", "420")
    if colour not in CHROMA:
        raise ValueError(f"Y4M samples of {colour}")
    by = CHROMA[colour]
    length = w * h + (2 * -(-w // by[0]) * -(-h // by[1]) if by else 0)
    rate = [int(x) for x in fields.get(b"F", "0:1").split(":")]
    first = len(line) + 1
    mark = head[first : first + HEADER].split(b"\n", 1)[0]
    if mark and mark != b"FRAME":
        raise ValueError("Y4M frames with parameters of their own")
    stride = len(b"FRAME\n") + length
    return Index("y4m", h, w, max(0, (size - first) // stride), first, stride, stride, fps=rate[0] / rate[1] if rate[0] and rate[1] else None, detail=colour)


def _chunks(file, at: int, end: int):
    """(name, place of its bytes, their number) of the chunks of an AVI file."""
    while at + 8 <= end:
        head = _at(file, at, 8)
        n = int.from_bytes(head[4:8], "little")
        yield head[:4], at + 8, n
        at += 8 + n + n % 2


def _avi(file, size: int) -> Index:
    h = w = 0
    fps, up, movi, listed = None, True, None, None
    for name, at, n in _chunks(file, 12, size):
        if name == b"LIST":
            kind = _at(file, at, 4)
            if kind == b"movi":
                movi = (at, min(n, size - at))
            elif kind == b"hdrl":
                head = _at(file, at, n)
                rate = int.from_bytes(head[head.index(b"avih") + 8 :][:4], "little")
                fps = 1e6 / rate if rate else None
                form = head[head.index(b"strf") + 8 :]
                w, h = (int.from_bytes(form[k : k + 4], "little", signed=True) for k in (4, 8))
                if int.from_bytes(form[14:16], "little") != 24 or int.from_bytes(form[16:20], "little"):
                    raise ValueError("only AVI frames of 24-bit pixels without compression are read")
                up, h = h > 0, abs(h)
        elif name == b"idx1":
            listed = np.frombuffer(_at(file, at, min(n, size - at) // 16 * 16), "<u4").reshape(-1, 4)
    if movi is None:
        return Index("avi", h, w, 0)
    length = (3 * w + 3) // 4 * 4 * h
    if listed is not None and len(listed):
        base = movi[0] if int(listed[0, 2]) < movi[0] else 0  # places count from the list's name, or from the file's start
        shown = listed[np.isin(listed[:, 0], [int.from_bytes(x, "little") for x in (b"00db", b"00dc")])]
        places = [(base + int(at) + 8, int(n)) for _, _, at, n in shown.tolist()]
    else:
        places = [(at, n) for name, at, n in _chunks(file, movi[0] + 4, movi[0] + movi[1]) if name in (b"00db", b"00dc")]
    places = [p for p in places if p[1] == length and sum(p) <= size]
    return Index("avi", h, w, len(places), places=places, fps=fps, detail=up)


def decode(found: Index, data: bytes) -> np.ndarray:
    """The BGR image of a frame's bytes."""
    h, w = found.height, found.width
    if found.kind == "ppm":
        m = PPM.match(data)
        if not m or found.detail is not None and data[: m.end()] != found.detail:
            raise ValueError("images of several sizes: read them with the option index=walk")
        rgb = np.frombuffer(data[m.end() :], np.uint8).reshape(int(m[2]), int(m[1]), 3)
        return np.ascontiguousarray(rgb[..., ::-1])
    if found.kind == "avi":
        rows = np.frombuffer(data, np.uint8).reshape(h, -1)[:, : 3 * w].reshape(h, w, 3)
        return np.ascontiguousarray(rows[::-1] if found.detail else rows)
    if not data.startswith(b"FRAME\n"):
        raise ValueError("a Y4M frame without its mark")
    samples = np.frombuffer(data, np.uint8)[len(b"FRAME\n") :]
    y, by = samples[: w * h].reshape(h, w), CHROMA[found.detail]
    if by is None:
        return np.repeat(y[..., None], 3, axis=2)
    cw, ch = -(-w // by[0]), -(-h // by[1])
    u, v = (samples[w * h + k * cw * ch :][: cw * ch].reshape(ch, cw).repeat(by[1], 0).repeat(by[0], 1)[:h, :w].astype(float) - 128 for k in (0, 1))
    light = 1.164383 * (y.astype(float) - 16)
    bgr = np.stack([light + 2.017232 * u, light - 0.391762 * u - 0.812968 * v, light + 1.596027 * v], axis=-1)
    return np.clip(np.rint(bgr), 0, 255).astype(np.uint8)


def encode_ppm(bgr: np.ndarray) -> bytes:
    h, w = bgr.shape[:2]
    return f"P6 {w} {h} 255\n".encode() + np.ascontiguousarray(bgr[..., ::-1]).tobytes()


class Writer:
    """Bytes of a video, frame by frame, for a stream that cannot be sought: sizes follow from the number of frames."""

    def __init__(self, kind: str, height: int, width: int, frames: int, fps: float = 30.0):
        self.kind, self.shape, self.frames, self.fps = kind, (height, width), frames, fps
        self.row = (3 * width + 3) // 4 * 4

    def start(self) -> bytes:
        h, w = self.shape
        if self.kind == "y4m":
            return f"YUV4MPEG2 W{w} H{h} F{round(self.fps * 1000)}:1000 Ip A1:1 Cmono\n".encode()
        if self.kind == "ppm":
            return b""
        n4 = lambda *v: b"".join(int(x).to_bytes(4, "little") for x in v)
        size = self.row * h
        avih = n4(1e6 / self.fps, 0, 0, 0x10, self.frames, 0, 1, size, w, h, 0, 0, 0, 0)
        strh = b"vidsDIB " + n4(0, 0, 0, 1, self.fps, 0, self.frames, size, 0, 0) + bytes(8)
        strf = n4(40, w, h) + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + n4(0, size, 0, 0, 0, 0)
        chunk = lambda name, body: name + n4(len(body)) + body
        hdrl = chunk(b"LIST", b"hdrl" + chunk(b"avih", avih) + chunk(b"LIST", b"strl" + chunk(b"strh", strh) + chunk(b"strf", strf)))
        movi = 4 + self.frames * (8 + size)
        return b"RIFF" + n4(4 + len(hdrl) + 8 + movi + 8 + 16 * self.frames) + b"AVI " + hdrl + b"LIST" + n4(movi) + b"movi"

    def frame(self, bgr: np.ndarray) -> bytes:
        if self.kind == "ppm":
            return encode_ppm(bgr)
        if self.kind == "y4m":
            b, g, r = (bgr[..., i].astype(np.int64) for i in range(3))
            return b"FRAME\n" + ((9798 * r + 19235 * g + 3735 * b + 16384) >> 15).astype(np.uint8).tobytes()
        h, w = self.shape
        rows = np.zeros((h, self.row), np.uint8)
        rows[:, : 3 * w] = bgr[::-1].reshape(h, -1)
        return b"00db" + rows.size.to_bytes(4, "little") + rows.tobytes()

    def end(self) -> bytes:
        if self.kind != "avi":
            return b""
        size = self.row * self.shape[0]
        entries = (b"00db" + b"".join(x.to_bytes(4, "little") for x in (0x10, 4 + k * (8 + size), size)) for k in range(self.frames))
        return b"idx1" + (16 * self.frames).to_bytes(4, "little") + b"".join(entries)
