"""The pipeline against plain versions of its stages, each on that stage's own input, and its behaviour on odd rows."""

import hashlib
import re
import zlib

import numpy as np
from test_corpus_operators import check_packing, plain_components, plain_distance, plain_pii, plain_simhash

import __spark_entry__ as entry
import corpus_pipeline
from tamis.llm import common, decontaminate, pii, toxicity


def words_of(text):
    return [w.lower() for w in re.findall(r"\w+", text)]


def plain_toxicity(text, scalars, bias):
    """The most toxic half-overlapping window, each word the mean of its buckets."""
    words = words_of(text)
    if not words:
        return 1 / (1 + np.exp(-bias))
    best = -np.inf
    for lo in range(0, max(1, len(words) - 24), 24):
        total = 0.0
        for w in set(words[lo : lo + 48]):
            grams = [f"<{w}>"[i : i + n] for n in (3, 4, 5) for i in range(len(w) + 3 - n)]
            buckets = [zlib.crc32(x.encode()) % toxicity.BUCKETS for x in (w, *grams)]
            total += np.mean(scalars[buckets], dtype=float)
        best = max(best, total / 48)
    return 1 / (1 + np.exp(-(best + bias)))


def test_stages_against_plain_versions(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-duplicates", "benchmark decontamination", "pii", "best-fit packing"]
    inputs, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        inputs.append({r["doc_id"]: r["text"] or "" for r in now.collect()})
        last = now
        now = common.materialise(stage(spark, now, sf_dir), "stage")
        if name != "best-fit packing":
            assert now.columns == docs.columns, name
    start, clean, single, safe, redacted = inputs
    scalars, bias = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    assert set(clean) == {i for i, t in start.items() if plain_toxicity(t, scalars, bias) < 0.5}
    ids = sorted(clean)
    roots = plain_components(ids, [plain_simhash(clean[i]) for i in ids])
    assert set(single) == set(roots)
    items = [words_of(r["text"]) for r in common.table(spark, sf_dir, "benchmark").collect()]
    for i, t in single.items():
        said = " " + " ".join(words_of(t)) + " "
        if i in safe:
            assert not any(" " + " ".join(item) + " " in said for item in items), i
        else:
            assert any(plain_distance(item, words_of(t)) <= decontaminate.edits(len(item)) for item in items), i
    for i, t in safe.items():
        left, at = redacted[i], 0
        for kind, a, b in plain_pii(t):
            assert t[a:b] not in left or t.count(t[a:b]) > 1 or a < at, (i, kind)
            at = max(at, b)
        kept = re.split("|".join(f"<{k.upper()}>" for k in pii.KINDS), left)
        assert all(part in t for part in kept)
    check_packing(last, now.collect())
    n_chars = {r["doc_id"]: r["n_chars"] for r in last.collect()}
    assert all(n_chars[i] == len(t) for i, t in redacted.items())

    def digest(df):
        return hashlib.sha256(repr(sorted(map(str, df.select("doc_id", "piece", "length", "ids_crc32").collect()))).encode()).hexdigest()

    assert digest(corpus_pipeline.run(spark, sf_dir)) == digest(now)


def test_odd_rows_pass_all_stages(spark, sf_dir):
    rows = [(1, None, None, None, 0, "x"), (None, "a b", "en", "s", 3, "x"), (2, "", "en", "s", 0, "x"), (3, "w " * 50_000, "en", "s", 1, "x"), (3, "w " * 50_000, "en", "s", 1, "x")]
    now = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string")
    for _, stage in corpus_pipeline.STAGES:
        now = common.materialise(stage(spark, now, sf_dir), "odd")
    assert {r["doc_id"] for r in now.collect()} == {None, 1, 3}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = common.materialise(stage(spark, empty, sf_dir), "empty")
    assert empty.count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
