"""Document quality without labels: a label model over heuristic labellers, and a hashed linear scorer.

Each labeller votes good, bad or abstains on every whole text. Expectation-maximisation (Dawid and Skene, 1979) over the
counts of vote patterns of all documents, at most 3 ** labellers of them, estimates each labeller's accuracy in either
class and the share of good documents. The posterior of its pattern is a document's soft label; on a bounded sample of
documents a logistic scorer over hashed features learns it: words, word shapes and binned statistics of the text. The
features are written to the shared folder; in each round, tasks go through their rows from the present weights, and the
driver takes the mean of theirs (McDonald, Hall and Mann, 2010), so that it holds a fixed number of bytes however long the
sample's texts are. Every document is then scored.
"""

from __future__ import annotations

import logging
import re
import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import arrow_map, materialise, texts
from tamis.session import reach

log = logging.getLogger(__name__)

BUCKETS = 1 << 18
#: The scorer's sample: so many documents, those of the smallest hash of their id.
MOST_DOCUMENTS = 6000
CACHE_ENTRIES = 400_000
#: Tasks that learn side by side, and rounds; each task sends the driver two numbers of four bytes for each bucket.
LEARNERS, ROUNDS = 8, 10
ABSTAIN, BAD, GOOD = 0, 1, 2
#: Frequent words of English, French, German and Spanish.
STOP = frozenset(
    "the of and to in a is that it was for on are as with be by this an at from or he his not have "
    "le la les de des du un une et en est que qui dans pour pas sur au par avec ce il "
    "der die das und ist nicht ein eine zu den von mit sich des auf für im dem als auch es "
    "el los las una y del se no por con para su al lo como más".split()
)
_SYMBOLS = "%$#*&|@{}<>=~^_\\+"


def statistics(text: str) -> tuple[float, ...]:
    """Words, distinct share, upper-case share, symbols a word, mean length, stop-word share, sentence ends a word,
    exclamation marks a word, repeated lines' share and the share of words that repeat the one before."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * 10
    lines = [x for x in text.split("\n") if x.strip()]
    return (
        float(n),
        len(set(words)) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(text.count, _SYMBOLS)) / n,
        sum(map(len, words)) / n,
        sum(map(STOP.__contains__, map(str.lower, words))) / n,
        (text.count(".") + text.count("?")) / n,
        text.count("!") / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        sum(map(eq, words, words[1:])) / n,
    )


def votes(s: tuple[float, ...]) -> tuple[int, ...]:
    """One vote of each labeller on a text's statistics."""
    n, distinct, upper, symbols, length, stop, ends, marks, lines, again = s

    def between(x: float, bad_below: float, good_from: float, good_to: float, bad_above: float) -> int:
        return BAD if x < bad_below or x > bad_above else GOOD if good_from <= x <= good_to else ABSTAIN

    usual = max(0.25, 0.75 - 0.0002 * n)  # long texts repeat words more
    return (
        between(n, 5, 20, 1e12, 1e12),
        between(distinct, 0.35 * usual, 0.6 * usual, 1, 1),
        between(upper, 0, 0, 0.2, 0.5),
        between(symbols, 0, 0, 0.05, 0.2),
        between(length, 2.0, 3.0, 10.0, 15.0),
        between(stop, 0.02, 0.08, 0.7, 0.9) if n >= 10 else ABSTAIN,
        between(ends, 0.002, 0.02, 0.4, 0.8) if n >= 30 else ABSTAIN,
        between(marks, 0, 0, 0.05, 0.3),
        between(lines, 0, 0, 0.1, 0.4),
        between(again, 0, 0, 0.1, 0.3),
    )


LABELLERS = len(votes((0.0,) * 10))


def pattern(v: tuple[int, ...]) -> int:
    out = 0
    for x in v:
        out = out * 3 + x
    return out


def _unpack(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3**k % 3 for k in range(LABELLERS - 1, -1, -1)], axis=1)


def label_model(counts: dict[int, int], rounds: int = 20_000) -> tuple[dict[int, float], np.ndarray, float]:
    """(posterior of good by pattern, vote chances by labeller, class and vote, share of good)."""
    if not counts:
        return {}, np.full((LABELLERS, 2, 3), 1 / 3), 0.5
    keys = np.array(sorted(counts), np.int64)
    weight = np.array([counts[k] for k in keys.tolist()], float)
    v = _unpack(keys)
    good = (v == GOOD).sum(1) + 1.0
    bad = 2.0 * (v == BAD).sum(1) + 1.0
    q = good**2 / (good**2 + (2 * bad) ** 2)
    one_hot = np.eye(3)[v]
    for _ in range(rounds):
        share = float(np.clip((weight * q).sum() / weight.sum(), 1e-3, 1 - 1e-3))
        soft = np.stack([1 - q, q], axis=1) * weight[:, None]
        chance = np.einsum("pc,pjv->jcv", soft, one_hot) + np.array([[0.2, 0.6, 0.2], [0.2, 0.05, 1.0]])
        chance /= chance.sum(2, keepdims=True)
        logs = np.log(chance)
        score = np.einsum("pjv,jcv->pc", one_hot, logs) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
        change = np.abs(new - q).max()
        q = new
        if change < 1e-9:
            break
    else:
        log.warning("label model: %.2g off a fixed point after %d rounds", change, rounds)
    return dict(zip(keys.tolist(), q.tolist(), strict=True)), chance, share


def word_features(word: str) -> tuple[int, int]:
    """Buckets of a word and of its shape."""
    shape = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "a", re.sub(r"\d+", "0", word))
    return zlib.crc32(word.lower().encode()) % BUCKETS, zlib.crc32(b"\x01" + shape.encode()) % BUCKETS


def text_features(s: tuple[float, ...]) -> list[int]:
    """Buckets of the binned statistics."""
    bins = (min(20, int(np.log2(s[0] + 1))), *(min(40, int(x * 20)) for x in s[1:4]), min(30, int(s[4])), *(min(40, int(x * 40)) for x in s[5:]))
    return [zlib.crc32(f"{k}={b}".encode()) % BUCKETS for k, b in enumerate(bins)]


def text_counts(text: str, s: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text, and their shares."""
    words = text.split()
    ids = [i for x in words for i in word_features(x)] + text_features(s) * max(1, len(words) // 9)
    u, c = np.unique(np.array(ids, np.int64), return_counts=True)
    return u, 3 * c / max(1, c.sum())


class Learner:
    """Logistic weights of the buckets (the last one is the bias) and their sums of squared gradients, by single rows."""

    def __init__(self, weights: np.ndarray, seen: np.ndarray, share: float, rate: float = 0.5):
        self.w, self.seen, self.rate, self.rows = weights, seen, rate, 0
        self.weight = (0.5 / (1 - share), 0.5 / share)

    def learn(self, u: np.ndarray, c: np.ndarray, target: float) -> None:
        """A row's buckets, their shares and its soft label."""
        u, c = np.append(u, BUCKETS), np.append(c, 1.0)
        p = 1 / (1 + np.exp(-np.clip(self.w[u] @ c, -30, 30)))
        g = (p - target) * (target * self.weight[1] + (1 - target) * self.weight[0]) * c
        self.seen[u] += g * g
        self.w[u] -= self.rate * g / np.sqrt(self.seen[u])
        self.rows += 1


def fit_scorer(sample: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the buckets and the bias, from a written ``sample(h, u, c, y)``: hash, buckets, shares, soft label. A round
    is a job; the rows of a task stream through in the order of their hashes."""
    spark = reach(sample.sparkSession)
    means = sample.agg(F.avg("y").alias("y"), F.count("*").alias("n")).first()
    w, seen = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-2)
    if not means["n"]:
        return w
    share = min(max(means["y"], 0.02), 0.98)
    learner = sample.withColumn("k", F.pmod("h", F.lit(LEARNERS)))
    dealt = materialise(learner.repartition(LEARNERS, "k").sortWithinPartitions("k", "h", "y"), "dealt")
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((w.astype(np.float32), seen.astype(np.float32)))  # a fixed size

        def run(batches, sent=sent):
            own: dict[int, Learner] = {}
            for batch in batches:
                for k, u, c, y in zip(batch.column("k").to_pylist(), batch.column("u"), batch.column("c"), batch.column("y").to_pylist(), strict=True):
                    if k not in own:
                        own[k] = Learner(*(x.astype(float) for x in sent.value), share)
                    own[k].learn(u.values.to_numpy().astype(np.int64), c.values.to_numpy(), y)
            for x in own.values():
                yield pa.RecordBatch.from_arrays([pa.array([x.rows]), *(pa.array([v.astype("<f4").tobytes()], pa.binary()) for v in (x.w, x.seen))], names=["n", "w", "seen"])

        # a row for each learner, or for each file of a learner whose rows fill several
        got = dealt.select("k", "u", "c", "y").mapInArrow(run, "n long, w binary, seen binary").collect()
        total = sum(r["n"] for r in got)
        w, seen = (sum(np.frombuffer(r[x], "<f4").astype(float) * (r["n"] / total) for r in got) for x in ("w", "seen"))
        sent.unpersist()
    return w


class Scorer:
    def __init__(self, weights: np.ndarray):
        self.w = weights
        self.known: dict[str, float] = {}

    def score(self, text: str, s: tuple[float, ...]) -> float:
        words = text.split()
        n = len(words)
        got = list(map(self.known.get, words))
        if None in got:
            if len(self.known) > CACHE_ENTRIES:
                self.known.clear()
            w = self.w
            for x in {x for x, y in zip(words, got, strict=True) if y is None}:
                a, b = word_features(x)
                self.known[x] = float(w[a] + w[b])
            got = [self.known[x] if y is None else y for x, y in zip(words, got, strict=True)]
        copies = max(1, n // 9)
        feats = text_features(s)
        z = 3 * (sum(got) + copies * float(self.w[feats].sum())) / (2 * n + copies * len(feats)) + self.w[-1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_DOCUMENTS) -> np.ndarray:
    """The scorer's weights; counts of vote patterns cover all documents, the scorer's sample is bounded by ``most``."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def make():
        def step(batch):
            got = [pattern(votes(statistics(t))) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32())], names=["p"])

        return step

    counts = {r["p"]: r["count"] for r in arrow_map(narrow, ["text"], "p int", make).groupBy("p").count().collect()}  # at most 3 ** labellers
    posterior, _, _ = label_model(counts)
    ids = narrow.where("id IS NOT NULL").select("id").orderBy(F.xxhash64("id"), "id").limit(most).distinct()

    def count():
        def step(batch):
            some = texts(batch)
            stats = [statistics(t) for t in some]
            got = [text_counts(t, s) for t, s in zip(some, stats, strict=True)]
            u, c = pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("g"), pa.array([pattern(votes(s)) for s in stats], pa.int32()), u, c], names=["h", "g", "p", "u", "c"])

        return step

    own = narrow.join(F.broadcast(ids), "id").select("text", F.xxhash64("id").alias("h"), F.xxhash64("text").alias("g"))
    counted = materialise(arrow_map(own, ["text", "h", "g"], "h long, g long, p int, u array<int>, c array<double>", count), "features")
    first = counted.select("h", "g").orderBy("h", "g").limit(most).distinct()  # ids may repeat: the bound is on rows
    soft = F.create_map(*(F.lit(x) for p, q in posterior.items() for x in (p, float(q)))) if posterior else F.lit(None)
    return fit_scorer(counted.join(F.broadcast(first), ["h", "g"]).select("h", "u", "c", F.element_at(soft, F.col("p")).alias("y"))) if posterior else np.zeros(BUCKETS + 1)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_DOCUMENTS) -> DataFrame:
    """Every row's id, ``score`` (0 to 1, higher is better) and ``predicted`` (1 from 0.5 up).

    Defined cases: a text without words (null, empty, white space) scores 0; null ids are scored and never in the sample;
    repeated rows are scored each; texts of any length are taken whole; ties among the sample's ids go by their hash, then
    id, and a pattern with even odds (a tie) teaches one half; an empty table gives no rows; other columns are left aside.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, most).astype(np.float32))  # a fixed size

    def make():
        scorer = Scorer(sent.value)

        def step(batch):
            got = []
            for t in texts(batch, text_col):
                s = statistics(t)
                got.append(scorer.score(t, s) if s[0] else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(got, pa.float64())], names=[id_col, "score"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    scored = arrow_map(docs, [id_col, text_col], f"`{id_col}` {kind}, score double", make)
    return scored.withColumn("predicted", F.expr("int(score >= 0.5)"))
