"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of itself and its character n-grams, hashed to buckets; its vector is the mean of their embeddings, so
an unseen misspelling shares vectors with the words it resembles. A passage of up to ``WINDOW`` words averages over
``WINDOW`` places, its distinct words and zeros for the rest, so that neither brevity nor repetition makes a word weigh
more; a softmax over two classes scores it, and the document scores as its most toxic passage. Training alternates: passages
of toxic documents are all positive at first, then only each document's most toxic ones are. For scoring, the softmax
and the embeddings collapse into one number for each bucket, so a word costs one cached lookup; rare buckets shrink towards
zero, and documents kept out of the training calibrate the scale.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import arrow_map, materialise, texts

WINDOW = 48
BUCKETS = 1 << 19
DIMENSIONS = 8
NGRAMS = (3, 4, 5)
#: The training sample: at most so many labelled documents of each class, with their whole texts.
MOST_OF_CLASS = 2000
#: A bucket in so many documents keeps half of its weight; every so many-th document of the sample calibrates.
SHRINK = 8.0
CALIBRATE = 5
WORD = re.compile(r"\w+")
CACHE_ENTRIES = 500_000


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def bucket_ids(word: str) -> list[int]:
    """Buckets of a word and of all its n-grams."""
    whole = zlib.crc32(word.encode()) % BUCKETS
    w = f"<{word}>"
    return [whole, *(zlib.crc32(w[i : i + n].encode()) % BUCKETS for n in NGRAMS for i in range(len(w) - n + 1))]


def coded(found: list[str], vocab: dict[str, int]) -> array:
    """Words as 32-bit places in ``vocab``, which grows by the new ones."""
    return array("i", [vocab.setdefault(w, len(vocab)) for w in found])


class Model:
    """Bucket embeddings and softmax weights, trained on batches of passages by plain gradient steps of a falling rate, which
    is a fifth of that of the embeddings for the softmax (a mean over the batch) and a tenth for its bias."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
        self.out = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.spread = np.zeros(BUCKETS, np.float32)
        self.scale = self.spread

    def fit(self, docs: list, labels: np.ndarray, vocab: list[str] | None = None, warm: int = 2, epochs: int = 30, rate: float = 20.0, batch: int = 128, seed: int = 7) -> Model:
        """``docs`` are word lists or, with ``vocab``, arrays of places in it."""
        if vocab is None:
            known: dict[str, int] = {}
            docs, vocab = [coded(d, known) for d in docs], list(known)
        bags = {int(w): np.array(bucket_ids(vocab[w]), np.int32) for w in np.unique(np.concatenate([np.zeros(0, np.int32), *(np.unique(d) for d in docs if len(d))]))}
        for d in docs:
            if len(d):
                self.spread[np.unique(np.concatenate([bags[w] for w in set(d)]))] += 1
        self._flat = np.concatenate([np.zeros(0, np.int32), *bags.values()])
        self._ends = np.cumsum([0, *map(len, bags.values())])
        place = np.zeros(len(vocab), np.int32)
        place[list(bags)] = np.arange(len(bags))
        del bags
        flat, ends, owner = array("i"), [0], []
        for k, d in enumerate(docs):
            for lo in range(0, len(d), WINDOW):
                flat.extend(sorted(set(d[lo : lo + WINDOW])))
                ends.append(len(flat))
                owner.append(k)
        if not owner:
            return self
        self._said, self._cuts = place[np.frombuffer(flat, np.int32)], np.array(ends)
        del flat, ends
        owner_arr = np.array(owner)
        truth = labels[owner_arr]
        rng = np.random.default_rng(seed)
        n = max(len(docs), 2)
        rare = np.clip(np.log(0.7 * n / np.maximum(self.spread, 1)), 0, None) / np.log(n)
        self.scale = (self.spread / (self.spread + SHRINK) * rare).astype(np.float32)
        rounds = warm + epochs
        for epoch in range(rounds):
            active = np.arange(len(owner))
            if epoch >= warm:
                scores = self._scalar_scores()
                order = np.lexsort((-scores, owner_arr))
                active = order[np.unique(owner_arr[order], return_index=True)[1]]
            share = np.bincount(truth[active], minlength=2)
            weight = len(active) * np.array([0.65, 0.35]) / np.maximum(share, 1)
            size = int(np.clip(len(active) // 20, 16, batch))
            for at in np.array_split(rng.permutation(active), max(1, len(active) // size)):
                self._step([self._said[self._cuts[i] : self._cuts[i + 1]] for i in at], truth[at], weight, rate * (1 - epoch / rounds))
        return self

    def _scalar_scores(self, run: int = 20_000) -> np.ndarray:
        per_word = self._word_scalars()
        out = []
        for lo in range(0, len(self._cuts) - 1, run):
            cuts = self._cuts[lo : lo + run + 1]
            out.append(np.add.reduceat(per_word[self._said[cuts[0] : cuts[-1]]], cuts[:-1] - cuts[0]) / WINDOW)
        return np.concatenate(out) + float(self.bias[1] - self.bias[0])

    def _word_scalars(self) -> np.ndarray:
        value = self.shrunk()[self._flat]
        return np.add.reduceat(value, self._ends[:-1]) / np.diff(self._ends)

    def scalars(self) -> np.ndarray:
        return self.emb @ (self.out[:, 1] - self.out[:, 0])

    def shrunk(self) -> np.ndarray:
        """The buckets' numbers, drawn to zero where few training documents have the bucket (unseen ones are zero)."""
        return self.scalars() * self.scale

    def _step(self, some: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        sizes = np.array([len(p) for p in some])
        used, inverse = np.unique(np.concatenate(some), return_inverse=True)
        row = np.repeat(np.arange(len(some)), sizes)
        spans = [(self._ends[u], self._ends[u + 1]) for u in used]
        flat = np.concatenate([self._flat[a:b] for a, b in spans])
        lens = np.array([b - a for a, b in spans])
        starts = np.cumsum([0, *lens[:-1]])
        word_vec = np.add.reduceat(self.emb[flat] * self.scale[flat, None], starts, axis=0) / lens[:, None]
        bag = np.add.reduceat(word_vec[inverse], np.cumsum([0, *sizes[:-1]]), axis=0) / WINDOW
        logits = bag @ self.out + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= weight[y][:, None]
        d_bag = p @ self.out.T / WINDOW
        self.out -= rate * (bag.T @ p) / len(y) / 5
        self.bias -= rate * p.mean(0) / 10
        d_word = np.stack([np.bincount(inverse, d_bag[row, c], len(used)) for c in range(DIMENSIONS)], axis=1)
        d_flat = np.repeat(d_word / lens[:, None], lens, axis=0) * self.scale[flat, None]
        ids, at = np.unique(flat, return_inverse=True)
        grad = np.stack([np.bincount(at, d_flat[:, c], len(ids)) for c in range(DIMENSIONS)], axis=1)
        self.emb[ids] -= (rate * grad).astype(np.float32)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", most: int = MOST_OF_CLASS) -> tuple[list[array], np.ndarray, list[str]]:
    """The bounded sample: by class, the labelled rows of the smallest hash that are not held out. Their whole texts as
    arrays of word numbers, their labels, and the words by number.

    Only the sample's ids (at most 2 * ``most``) are broadcast; the texts come to the driver in order, a partition at a
    time, and stay there as four bytes a word."""
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(id_col)).select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("y"))
    order = [F.xxhash64("id"), "id", "y"]
    sample = known.where("y = 1").orderBy(*order).limit(most).unionByName(known.where("y = 0").orderBy(*order).limit(most))
    found = docs.select(F.col(id_col).alias("id"), "text").join(F.broadcast(sample.distinct()), "id")

    def make():
        def step(batch):
            out = [" ".join(words(t)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string()), batch.column("y")], names=["id", "words", "y"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    sampled = materialise(arrow_map(found, ["id", "text", "y"], f"id {kind}, words string, y int", make), "sample")
    vocab: dict[str, int] = {}
    rows, y = [], []
    for r in sampled.orderBy("id", "y", "words").toLocalIterator():
        rows.append(coded(r["words"].split(), vocab))
        y.append(r["y"])
    return rows, np.array(y, np.int64), list(vocab)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", most: int = MOST_OF_CLASS) -> tuple[np.ndarray, float]:
    """(number of each bucket, bias) of a trained model; without both classes every score is the one class seen."""
    rows, y, vocab = training_rows(docs, labels, id_col, most)
    if len(set(y.tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), 20.0 if len(y) and y[0] == 1 else -20.0
    return fit_rows(rows, y, vocab)


def fit_rows(rows: list[array], y: np.ndarray, vocab: list[str]) -> tuple[np.ndarray, float]:
    """Model of labelled rows: trained on most, then scaled and shifted by a logistic fit of the rest's scores, which
    are those of whole texts by the windows of scoring."""
    order = np.argsort([zlib.crc32(" ".join([vocab[w] for w in r]).encode()) for r in rows], kind="stable")
    own = np.arange(len(rows)) % CALIBRATE == 0
    held, used = order[own], order[~own]
    if min(np.bincount(y[held], minlength=2).min(), np.bincount(y[used], minlength=2).min()) < 3:
        held = used = order
    model = Model().fit([rows[i] for i in used], y[used], vocab)
    scalars = model.shrunk().astype(np.float32)
    scorer = Scorer(scalars, 0.0)
    x = np.array([scorer.logit([vocab[w] for w in rows[i]]) for i in held])
    a, b = _logistic_fit(x, y[held])
    return scalars * np.float32(a), b


def _logistic_fit(x: np.ndarray, y: np.ndarray, rounds: int = 4000, ridge: float = 0.02) -> tuple[float, float]:
    """Slope (positive) and intercept of a weighted logistic regression, by gradient steps."""
    share = np.bincount(y, minlength=2) / len(y)
    weight = np.where(y == 1, 0.35 / share[1], 0.65 / share[0]) / len(y)
    mid, wide = float(x.mean()), float(x.std()) + 1e-6
    z, a, b = (x - mid) / wide, 1.0, -0.6
    for _ in range(rounds):
        g = weight * (1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - y)
        a, b = max(0.05, a - (g * z).sum() - ridge * 0.05 * a), b - g.sum()
    return a / wide, b - a * mid / wide


class Scorer:
    """Scores texts in one task; words are cached up to a bound."""

    def __init__(self, scalars: np.ndarray, bias: float, entries: int = CACHE_ENTRIES):
        self.scalars, self.bias, self.entries = scalars, bias, entries
        self.known: dict[str, float] = {}

    def _learn(self, needed: set[str]) -> None:
        missing = [w for w in needed if w not in self.known]
        if not missing:
            return
        if len(self.known) + len(missing) > self.entries:
            self.known.clear()
            missing = list(needed)
        bags = [bucket_ids(w) for w in missing]
        flat = self.scalars[np.array([b for bag in bags for b in bag], np.int64)].astype(np.float64)
        lens = np.array([len(bag) for bag in bags])
        sums = np.add.reduceat(flat, np.cumsum([0, *lens[:-1]])) / lens
        self.known.update(zip(missing, sums.tolist(), strict=True))

    def score(self, text: str) -> float:
        return _logistic(self.logit(words(text)))

    def logit(self, found: list[str]) -> float:
        if not found:
            return self.bias
        self._learn(set(found))
        at, half = self.known.__getitem__, WINDOW // 2
        best = max(sum(map(at, set(found[lo : lo + WINDOW]))) for lo in range(0, max(1, len(found) - half), half))
        return best / WINDOW + self.bias


def _logistic(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: one number for each bucket

    def make():
        scorer = Scorer(*sent.value)

        def step(batch):
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([scorer.score(t) for t in texts(batch, text_col)], pa.float64())], names=[id_col, "score"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs, [id_col, text_col], f"`{id_col}` {kind}, score double", make)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", most: int = MOST_OF_CLASS) -> DataFrame:
    """Every row's id, ``held_out``, ``score`` and ``predicted``.

    Defined cases: a text without a word (null, empty, signs alone) scores as the bias alone does; a null id scores and
    is not held out; labels with a null id, or other than 0 and 1, teach nothing; with labels of one class, or none,
    every score is near that class (near 0 without any); repeated rows are scored each; texts of any length are taken
    whole; a score of exactly 0.5 (a tie) is predicted 1; an empty table gives no rows.
    """
    scored = score_documents(docs, fit(docs, labels, id_col, most), id_col)
    return scored.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score", F.expr("int(score >= 0.5)").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_OF_CLASS) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; all columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, most))  # a fixed size

    def make():
        scorer = Scorer(*sent.value)

        def step(batch):
            kept = [scorer.score(t) < 0.5 for t in texts(batch, text_col)]
            yield batch if all(kept) else batch.filter(pa.array(kept, pa.bool_()))

        return step

    return arrow_map(docs, docs.columns, docs.schema, make)
