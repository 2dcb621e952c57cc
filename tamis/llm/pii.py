"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes for what they miss.

The patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers by exact rules in time linear in the
text. The field adds names after a title or an introduction, secrets, national phone numbers and identity numbers. It is
trained by gradient ascent on the small labelled table of this module (its sentences vary by rule), once on the driver.

Every word of every text is scored, in numpy batches of whole texts. A run of words inside spans can only be best where
its scores' lead over "outside" makes up for its transitions at their most favourable; prefix sums give an upper bound for
all runs at once, and Viterbi decodes the runs that reach it. The others are outside by this bound, so the states are
those of Viterbi over whole texts. Spans count code points; spans of the field that touch a pattern's span give way.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import arrow_map, texts

BASE_KINDS = ("email", "ip", "card", "phone")
FIELD_KINDS = ("name", "secret", "tel", "id")
KINDS = BASE_KINDS + FIELD_KINDS

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    return out


def ips(text: str) -> list[Span]:
    out = []
    for m in _DOTTED.finditer(text):
        if m.end() - m.start() < 7:
            continue
        parts = m[0].split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 and not p[:-3].strip("0") for p in four):
                out.append(("ip", at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    return out


def phones(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15] if "+" in text else []


def base_spans(text: str) -> list[Span]:
    """By start, then kind."""
    digits = _DIGIT.search(text)
    found = emails(text) + (ips(text) + cards(text) if digits else []) + (phones(text) if digits else [])
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# The field --------------------------------------------------------------------------------------------------------

#: Cue words, lower case.
TITLES = ("mr", "mrs", "ms", "dr", "prof", "herr", "frau", "monsieur", "madame", "señor", "señora")
INTRODUCTIONS = ("name", "nombre", "nom")
SIGNATURES = ("signed", "named")
COPULAS = ("is", "ist", "est", "es")
FUNCTION_WORDS = frozenset(("the", "and", "of", "to", "in", "a", "that", "this", "und", "die", "der", "das", "para", "que", "les", "le", "la", "el", "los", "et", "de", "it", "they", "were", "was"))
SECRET_CUES = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "passwort", "contraseña")
PHONE_CUES = ("phone", "tel", "telephone", "call", "fax", "mobile", "telefon", "teléfono", "téléphone")
ID_CUES = ("ssn", "iban", "passport", "license", "id", "dni", "nif")
STATES = ("O", *(f"{p}-{k}" for k in FIELD_KINDS for p in "BI"))
_WORD = re.compile(r"\S+")
#: Words scored at once; a longer text is taken whole.
CHUNK_WORDS = 200_000
_HEX = re.compile(r"[0-9a-fA-F]{16,}")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_KEY = re.compile(r"[\"']?[\w-]*[\"']?[=:][\"']?")


_CUES = {w: kind for kind, cues in (("title", TITLES), ("intro", INTRODUCTIONS), ("signed", SIGNATURES), ("copula", COPULAS), ("secretcue", SECRET_CUES), ("phonecue", PHONE_CUES), ("idcue", ID_CUES)) for w in cues}


def shape(word: str) -> str:
    """A word's class: its cue, the alphabet of a code, or its runs of letters, digits and signs, digits with their number."""
    plain = word.rstrip(".,;:!?")
    if plain.isalpha():
        low = plain.lower()
        kind = _CUES.get(low) or ("function" if low in FUNCTION_WORDS else None)
        if kind:
            return "secretkey" if kind == "secretcue" and word[-1] == ":" else kind
        if low == plain:
            return "x"
        if len(plain) > 1 and plain[0].isupper() and low[1:] == plain[1:]:
            return "Xx"
        if len(plain) > 1 and plain.isupper():
            return "XX"
    bare = word.strip(".,;:!?()\"'").lower()
    if bare in SECRET_CUES and word[-1] == ":":
        return "secretkey"
    if bare in _CUES:
        return _CUES[bare]
    key = re.match(r"(?i)[\"']?([\w-]+)[\"']?[=:](.+)", word)
    if key and key[1].lower() in SECRET_CUES:
        return "key=value"
    if word[-1] == "=" and bare.rstrip("=:").strip("\"'") in SECRET_CUES:
        return "secretkey"
    if word[0] in "=:" and word.strip("=:\"'"):
        return "=value"
    core = word.strip(".,;:!?()\"'#*$%&|")
    if re.search("[0-9]", core) and re.search("[A-Za-z]", core):
        if _HEX.fullmatch(core):
            return "hex"
        if _BASE64.fullmatch(core) and re.search("[A-Z]", core) and re.search("[a-z]", core):
            return "base64"
    out = []
    for m in re.finditer(r"[0-9]+|[A-ZÀ-ÖØ-Þ]+|[^\W\d_]+|.", word):
        c = m[0]
        out.append(f"d{len(c)}" if c[0].isdigit() else ("X" if len(c) == 1 else "XX") if c[0].isupper() else "x" if c[0].isalpha() else c)
    text = "".join(out)
    if re.search("d", text) and re.search("[xX]", text):
        return "mixed"
    if len(text) > 12:
        return "many"
    return text.rstrip(".,;:!?") or "sign"


def _training_table() -> list[tuple[list[str], list[str]]]:
    """Labelled sentences: words, and a state for each."""
    first = ("Anna", "John", "Maria", "Peter", "Claire", "Hans", "Lucia", "Omar")
    last = ("Smith", "Meyer", "Garcia", "Dubois", "Brown", "Rossi", "Khan", "Novak")
    fill = ("The", "river", "and", "old", "houses,", "were", "Und", "die", "schön", "para", "que", "les", "of", "that.")
    out = []
    for i in range(8):
        a, b, c, d = (fill[(i * 5 + k * 3) % len(fill)] for k in range(4))
        f, n, m = first[i], last[i], last[(i + 3) % 8]
        t = ("Mr.", "Mrs.", "Dr.", "Herr", "Frau", "Ms.", "Madame", "Señor")[i]
        code = hashlib.sha256(str(i).encode()).hexdigest()
        base64 = "".join(x.upper() if k % 3 else x for k, x in enumerate(code[20 : 44 + 2 * i] + "gq")) + "="
        area, mid, end = f"{200 + 37 * i}", f"{555 + i}", f"{1000 + 713 * i}"[:4]
        for words, states in (
            ((a, b, t, f, n, c, d), "O O O B-name I-name O O"),
            ((a, t, n + ",", b, c), "O O B-name O O"),
            ((a, t, n + ".", fill[0], b), "O O B-name O O"),
            (("my", "name", "is", f, n, a, b), "O O O B-name I-name O O"),
            ((a, "name", "is", f + ".", b, c), "O O O B-name O O"),
            ((a, "name", "is", b.lower(), c.lower(), d), "O O O O O O"),
            ((a, "name:", f, n, b), "O O B-name I-name O"),
            ((a, b, "is", f, n, c), "O O O O O O"),
            ((t, f, n + ",", f"{area}", b), "O B-name I-name O O"),
            (("signed", f, m + ".", a, b), "O B-name I-name O O"),
            ((a, "name", b, c), "O O O O"),
            ((a, b, f"password={code[:12 + i]}", c, d), "O O B-secret O O"),
            ((a, f"token={code[8:30]}", b, c), "O B-secret O O"),
            ((a, "api_key:", code[:20], b, c), "O O B-secret O O"),
            ((a, "password", b, c, d), "O O O O O"),
            ((a, b, "token", "=", f'"{code[:40]}"', c, d), "O O O O B-secret O O"),
            ((a, "secret", "=", code[: 32 + 4 * i] + ".", b, c), "O O O B-secret O O"),
            ((a, "password", "=", f'"{(f, n, m, b)[i % 4]}{area}"', b), "O O O B-secret O"),
            ((a, "password", "=", f'"{b}"', c, d), "O O O B-secret O O"),
            ((a, "pwd", "=", b, c), "O O O B-secret O"),
            ((a, "token", "=", base64, b, c), "O O O B-secret O O"),
            ((a, "token", ":", base64, b), "O O O B-secret O"),
            ((a, "secret", f'="{code[:40]}"', b, c), "O O B-secret O O"),
            ((a, "secret", "=", "-".join((f, n, m, "Up", "Down")), b), "O O O B-secret O"),
            ((a, '"token":', f'"{code[:40]}",', b, c), "O O B-secret O O"),
            ((a, "token=", code[:40], b, c), "O O B-secret O O"),
            ((a, "passwd:", f'"{b}"', c), "O O B-secret O"),
            ((a, "password", "is", f"{b.strip(',.')}{area}", c), "O O O B-secret O"),
            ((a, "password", "is", b, c), "O O O O O"),
            ((a, "token:", base64, b), "O O B-secret O"),
            ((a, "api_key:", "-".join((f, n, m, "Up", "Down")), b), "O O B-secret O"),
            ((a, "password:", b, c, d), "O O O O O"),
            ((a, "secret", base64, b, c), "O O B-secret O O"),
            ((a, b, "=", code[:40], c), "O O O O O"),
            ((a, b, "=", f'"{code[:40]}"', c), "O O O O O"),
            ((a, b, "=", base64, c), "O O O O O"),
            ((a, b, "=", f'"{c}"', d), "O O O O O"),
            ((a, b, "=", mid, d), "O O O O O"),
            ((a, "token", b, code[:40], c), "O O O O O"),
            ((a, "token", b, c, "=", d), "O O O O O O"),
            ((a, code[:40], b, c), "O O O O"),
            ((a, base64, b, c), "O O O O"),
            ((a, f"https://{f}.example.org/{n}-of/{m}_x.html".lower(), b), "O O O"),
            ((a, b, f"={c}", d), "O O O O"),
            ((a, "call", f"({area})", f"{mid}-{end}", b), "O O B-tel I-tel O"),
            ((a, b, f"({area})", f"{mid}-{end}.", fill[2], c), "O O B-tel I-tel O O"),
            ((a, "tel", f"{area}-{mid}-{end}", b, c), "O O B-tel O O"),
            ((a, b, f"{area}-{mid}-{end}", c, d), "O O B-tel O O"),
            ((a, "ssn", f"{area}-{10 + i}-{end}", b), "O O B-id O"),
            ((a, b, f"{area}-{10 + i}-{end}", c), "O O B-id O"),
            ((a, b, str(1900 + 9 * i), c, d), "O O O O O"),
            ((a, f"{i + 1}.", b, c), "O O O O"),
            ((a, b, f"{area},{mid}", c), "O O O O"),
            ((a, f"{i}.{area}", b, f"{mid}%", d), "O O O O O"),
            ((a, f"x={i}", b, c), "O O O O"),
            ((a, code[:16], b, c), "O O O O"),
            ((a, "4" + "".join(str((i * 7 + k) % 10) for k in range(15)), b, c), "O O O O"),
            ((n, f, a, b), "O O O O"),
            ((n + ".", f, m, a, "5", d), "O O O O O O"),
            ((a, str(7 * i), n, f + ".", m, b), "O O O O O O"),
            ((f, n + ".", f"{area}", "X", "XX"), "O O O O O"),
            (("LE!!", f"{f}!!".upper(), n + ".", f, b, c), "O O O O O O"),
            ((a, f.upper(), "NOM,!!", f"{n}!!".upper(), m + ".", f), "O O O O O O"),
            ((a, b, c, d, fill[i], fill[i + 3], fill[i + 5]), "O O O O O O O"),
            ((fill[i], "=", b, "-", d), "O O O O O"),
            ((a, f"u{i}@mail.example.org", b), "O O O"),
            ((a, f"10.0.{i}.{area}", b), "O O O"),
            ((a, f"+1 ({area}) {mid}-{end}".split()[0], f"({area})", f"{mid}-{end}", b), "O O B-tel I-tel O"),
        ):
            out.append((list(words), states.split()))
    return out


class Shapes(dict):
    """Shape ids by word, made when first asked for; emptied at a bound, which changes no result."""

    def __init__(self, ids: dict[str, int], entries: int = 500_000):
        super().__init__()
        self.ids, self.entries = ids, entries

    def __missing__(self, word: str) -> int:
        if len(self) >= self.entries:
            self.clear()
        got = self[word] = self.ids.get(shape(word), 0)
        return got


class Field:
    """Weights of the chain. The features of a place are the shapes of its word, of the two words before and of the one
    after, and the pairs of its shape with the last one and of the last two; 0 is any other shape, or beyond the edges."""

    def __init__(self, table: list[tuple[list[str], list[str]]] | None = None, steps: int = 150):
        table = table or _training_table()
        shapes = sorted({shape(w) for words, _ in table for w in words})
        self.ids = {s: i + 1 for i, s in enumerate(shapes)}
        n, k = len(shapes) + 1, len(STATES)
        self.n = n
        self.w = np.zeros((4 * n + 2 * n * n, k))
        self.t = np.zeros((k, k))
        self.ban = np.array([[-1e4 if b[0] == "I" and a[2:] != b[2:] else 0.0 for b in STATES] for a in STATES])
        self.start = np.array([-1e4 if s[0] == "I" else 0.0 for s in STATES])
        x, y, live = self._numbered(table)
        gw, gt = np.full_like(self.w, 1e-2), np.full_like(self.t, 1e-2)
        decay = 1e-3 * len(table)
        for _ in range(steps):
            _, dw, dt = self.gradient(x, y, live)
            dw, dt = dw - decay * self.w, dt - decay * self.t
            gw += dw**2
            gt += dt**2
            self.w += 0.5 * dw / np.sqrt(gw)
            self.t += 0.5 * dt / np.sqrt(gt)

    def _numbered(self, table: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded shape ids and states of sentences, and where they are."""
        size = np.array([len(w) for w, _ in table])
        x, y = np.zeros((2, len(table), size.max()), np.int64)
        for i, (words, states) in enumerate(table):
            x[i, : len(words)] = [self.ids.get(shape(w), 0) for w in words]
            y[i, : len(words)] = [STATES.index(s) for s in states]
        return x, y, np.arange(x.shape[1]) < size[:, None]

    def features(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows of ``w`` for each place along the last axis of shape ids."""
        n = self.n
        wide = np.zeros((*x.shape[:-1], x.shape[-1] + 3), np.int64)
        wide[..., 2:-1] = x
        one, two, after = wide[..., 1:-2], wide[..., :-3], wide[..., 3:]
        return x, one + n, after + 2 * n, two + 3 * n, 4 * n + one * n + x, 4 * n + n * n + two * n + one

    def emissions(self, x: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
        w = self.w if w is None else w
        first, *rest = self.features(x)
        e = w[first]
        for f in rest:
            e += w[f]
        return e

    def gradient(self, x: np.ndarray, y: np.ndarray, live: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of the sentences, and its gradients by ``w`` and ``t``, forwards and backwards."""
        k, longest = len(STATES), x.shape[1]
        e, trans = self.emissions(x), self.t + self.ban
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + self.start
        for j in range(1, longest):
            step = _lse(alpha[:, j - 1, :, None] + trans, 1) + e[:, j]
            alpha[:, j] = np.where(live[:, j, None], step, alpha[:, j - 1])
        for j in range(longest - 2, -1, -1):
            step = _lse(trans + (e[:, j + 1] + beta[:, j + 1])[:, None, :], 2)
            beta[:, j] = np.where(live[:, j + 1, None], step, 0)
        z = _lse(alpha[:, -1], 1)
        node = np.exp(np.where(live[..., None], alpha + beta - z[:, None, None], -np.inf))
        d = np.eye(k)[y] * live[..., None] - node
        dw, dt = np.zeros_like(self.w), np.zeros_like(self.t)
        for ids in self.features(x):
            flat = ids[live]
            for s in range(k):
                dw[:, s] += np.bincount(flat, d[live][:, s], len(dw))
        said = (np.take_along_axis(e, y[..., None], 2)[..., 0] * live).sum() + self.start[y[:, 0]].sum()
        for j in range(1, longest):
            on = live[:, j]
            both = alpha[on, j - 1, :, None] + trans + (e[on, j] + beta[on, j])[:, None, :] - z[on, None, None]
            dt -= np.exp(both).sum(0)
            np.add.at(dt, (y[on, j - 1], y[on, j]), 1)
            said += trans[y[on, j - 1], y[on, j]].sum()
        return float(said - z.sum()), dw, dt

    def decode(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """The best states of each row of shape ids: those of Viterbi over the whole row."""
        out, lo = [], 0
        while lo < len(rows):
            hi, words = lo, 0
            while hi < len(rows) and (hi == lo or words + len(rows[hi]) <= CHUNK_WORDS):
                words += len(rows[hi])
                hi += 1
            out += self._decode(rows[lo:hi])
            lo = hi
        return out

    def _decode(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        size = np.array([len(r) for r in rows])
        first = np.cumsum(size + 2) - size  # two places beyond the edges lie before each row
        flat = np.zeros(int((size + 2).sum()) + 1, np.int64)
        inside = np.zeros(len(flat), bool)
        for a, n, r in zip(first.tolist(), size.tolist(), rows, strict=True):
            flat[a : a + n] = r
            inside[a : a + n] = True
        e = self.emissions(flat, self.w.astype(np.float32))
        trans = self.t + self.ban
        best = trans - trans[0, 0]
        best[0, 0] = -np.inf
        most = max(0.0, best.max())
        lead = np.where(inside, e[:, 1:].max(1) - e[:, 0] + most, -1e3).astype(float)
        total = np.concatenate([[0.0], np.cumsum(lead)])
        to_here = total[1:] - np.minimum.accumulate(total[:-1])
        from_here = np.maximum.accumulate(total[:0:-1])[::-1] - total[:-1]
        open_ = inside & (to_here + from_here - lead + most >= -1e-2)
        state = np.zeros(len(flat), np.int8)
        edge = np.diff(np.concatenate([[0], open_.view(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(starts):
            self._viterbi(flat, inside, state, starts, ends, trans)
        return [state[a : a + n] for a, n in zip(first.tolist(), size.tolist(), strict=True)]

    def _viterbi(self, flat: np.ndarray, inside: np.ndarray, state: np.ndarray, starts: np.ndarray, ends: np.ndarray, trans: np.ndarray) -> None:
        """Sets the best states of runs [start, end) between words that are outside, or edges."""
        order = np.argsort(ends - starts, kind="stable")
        at = 0
        while at < len(order):
            long = int((ends - starts)[order[min(at + 4095, len(order) - 1)]])
            some = order[at : at + max(1, min(4096, 400_000 // long))]
            at += len(some)
            a, n = starts[some], (ends - starts)[some]
            width = int(n.max())
            places = np.minimum(a[:, None] + np.arange(width), (a + n - 1)[:, None])
            grid = flat[np.clip(a[:, None] + np.arange(-2, width + 1), 0, len(flat) - 1)]
            e = self.emissions(grid)[:, 2:-1]
            best = e[:, 0] + np.where(inside[a - 1, None], trans[0], self.start)
            last = np.where(inside[a + n, None], trans[:, 0], 0.0)
            back = np.zeros((len(some), width, len(STATES)), np.int8)
            stay = np.arange(len(STATES))
            for j in range(1, width):
                offer = best[:, :, None] + trans
                pick = offer.argmax(1)
                on = (j < n)[:, None]
                back[:, j] = np.where(on, pick, stay)
                best = np.where(on, np.take_along_axis(offer, pick[:, None, :], 1)[:, 0] + e[:, j], best)
            now = (best + last).argmax(1)
            row = np.arange(len(some))
            for j in range(width - 1, -1, -1):
                state[places[:, j]] = now
                now = back[row, j, now]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


@lru_cache(maxsize=1)
def field() -> Field:
    """Trained once in a process; tasks are sent the driver's."""
    return Field()


class Finder:
    """A field with its cache of shapes, in one task."""

    def __init__(self, model: Field):
        self.model, self.shapes = model, Shapes(model.ids)

    def field_spans(self, some: list[str]) -> list[list[Span]]:
        """The field's spans of each text."""
        look = self.shapes.__getitem__
        rows = [np.fromiter(map(look, t.split()), np.int64) for t in some]
        out: list[list[Span]] = []
        for text, states in zip(some, self.model.decode(rows), strict=True):
            at = np.flatnonzero(states)
            out.append(_spans(text, states, at.tolist()) if len(at) else [])
        return out

    def all_spans(self, some: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """(pattern spans, all spans) of each text, by start, then kind."""
        out = []
        for text, extra in zip(some, self.field_spans(some), strict=True):
            base = base_spans(text)
            out.append((base, merged(base, extra) if extra else base))
        return out


def _spans(text: str, states: np.ndarray, at: list[int]) -> list[Span]:
    """Spans of a text from its words' states; ``at`` are the places of those inside spans."""
    places = [m.span() for m in _WORD.finditer(text)]
    out = []
    for i in at:
        name = STATES[states[i]]
        if name[0] != "B":
            continue
        j = i + 1
        while j < len(states) and STATES[states[j]] == f"I-{name[2:]}":
            j += 1
        start, first_end = places[i]
        last, end = places[j - 1]
        word = text[start:first_end]
        end = last + len(text[last:end].rstrip(".,;:!?\"'"))
        if name[2:] == "secret":
            key = _KEY.match(word)
            start += key.end() if key and key.end() < len(word) else word[0] in "\"'"
            closed = text.find(text[start - 1], start, end) if text[start - 1 : start] in ("'", '"') else -1
            end = closed if closed > start else end
        if start < end:
            out.append((name[2:], start, end))
    return out


def merged(base: list[Span], extra: list[Span]) -> list[Span]:
    """All spans of ``base`` and those of ``extra`` that touch none of them, by start, then kind, in one sweep; spans of
    ``extra`` come in order and do not touch each other."""
    out, k, reach = list(base), 0, -1
    for s in extra:
        while k < len(base) and base[k][1] < s[2]:
            reach = max(reach, base[k][2])
            k += 1
        if reach <= s[1]:
            out.append(s)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def all_spans(some: list[str]) -> list[tuple[list[Span], list[Span]]]:
    return Finder(field()).all_spans(some)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, counts of the patterns' spans, ``base_sha256`` and ``spans``.

    Defined cases: a null or empty text has no spans (the digest of the empty string); null ids and repeated rows are
    answered like others; texts of any length are taken whole; of spans that start together (ties) the pattern's kind in
    ``KINDS`` goes first; an empty table gives no rows; other columns are left aside.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field())  # a fixed size: weights by shapes of the table

    def make():
        finder = Finder(sent.value)

        def step(batch):
            got = finder.all_spans(texts(batch, text_col))
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in got], pa.int64()) for k in BASE_KINDS]
            digest = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in got])
            names = [id_col, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *counts, digest, pa.array([joined(s) for _, s in got], pa.string())], names=names)

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs, [id_col, text_col], f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", make)


def redacted(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for kind, a, b in spans:
        if b <= at:
            continue
        out += [text[at : max(a, at)], f"<{kind.upper()}>"]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind, and ``length_col`` following; null texts stay null."""

    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(field())  # a fixed size

    def make():
        finder = Finder(sent.value)

        def step(batch):
            old = batch.column(text_col).to_pylist()
            got = finder.all_spans([t or "" for t in old])
            new = pa.array([None if t is None else redacted(t, s) for t, (_, s) in zip(old, got, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

        return step

    out = arrow_map(docs, docs.columns, docs.schema, make)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        length = F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(F.char_length(text_col).cast(kind))
        out = out.withColumn(length_col, length)
    return out
