"""Hard negatives against brute force and their SQL."""

import duckdb
import numpy as np
import pytest

from tamis.llm import negatives, queries

KIND = "vec_id long, embedding array<float>, label int, id string, `a.b` int"


def plain(rows, every=100, top=5, most=10):
    """Of (id, label, integer vector)."""
    out = []
    for k, (a, la, va) in enumerate(rows):
        if a % every:
            continue
        width = max((len(v) for _, _, v in rows), default=0)
        pad = lambda v: np.array(list(v) + [0] * (width - len(v)), object)
        score = [int((pad(va) * pad(v)).sum()) for _, _, v in rows]
        close = sorted((-s, i) for s, (i, l, _) in zip(score, rows, strict=True) if l == la and i != a)[:top]
        for s, p in close:
            far = sorted((-x, i) for x, (i, l, _) in zip(score, rows, strict=True) if l != la and 30 * -s <= 100 * x <= 90 * -s)[:most]
            out += [(a, p, r + 1, i, -s, -x) for r, (x, i) in enumerate(far)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_the_query_equals_its_sql(spark, sf_dir):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = c.execute(queries.OP12_SQL)
    names = [d[0] for d in want.description]
    want = sorted(tuple(r[names.index(n)] for n in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in want.fetchall())
    got = rows_of(queries.op12_hard_negatives(spark, sf_dir))
    assert got == want and len(got) > 0


@pytest.mark.parametrize("labels", [2, 5])
def test_many_blocks_buckets_and_ties(spark, monkeypatch, labels):
    monkeypatch.setattr(negatives, "ROWS", 16)
    monkeypatch.setattr(negatives, "BLOCKS", 2)
    monkeypatch.setattr(negatives, "ENTRIES", 12)
    rng = np.random.default_rng(labels)
    rows = [(int(i), int(rng.integers(labels)) if i % 3 else 0, [int(x) for x in rng.integers(-3, 9, 4)]) for i in range(400)]
    rows += [(500, 1, [9, 9, 9, 9])] * 2 + [(500, 0, [9, 9, 9, 9]), (37, 0, [5, 5, 5, 5])] + [(600 + i, 1, [2, 2, 2, 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(4)
    assert rows_of(negatives.mine(df, every=20)) == plain(rows, every=20)


def test_bounds_hold_and_spare_most_rows():
    rng = np.random.default_rng(1)
    vectors = np.floor(256 * rng.normal(0, 0.125, (4000, 64))).astype(np.int64)
    low = vectors.min(0)
    step = np.maximum(1, -(-(vectors.max(0) - low + 1) // negatives.CELLS))
    cell = ((vectors - low) // step).astype(np.uint8)
    made = negatives.Anchors([(i, i, 0, vectors[i].tolist(), [(4000, 20000)]) for i in range(20)], low, step, 10, False)
    under, over = (sum(t[d][cell[:, d]].astype(np.int64) for d in range(64)) for t in (made.under, made.over))
    exact = vectors @ vectors[:20].T
    assert (under <= exact).all() and (exact <= over).all()
    made.meet(np.arange(4000), np.ones(4000, np.int64), cell, vectors)
    for k in range(20):
        on = np.flatnonzero((exact[:, k] >= 4000) & (exact[:, k] <= 20000))
        assert made.ids[k, 0].tolist() == sorted(on, key=lambda i: (-exact[i, k], i))[:10]
    assert made.exact < 0.05 * exact.size


def test_odd_rows(spark):
    bad = [None, [], [1.0, None], [float("nan"), 0.0], [float("inf"), 0.0]]
    rows = [(100 * k + 1, v, 3, "x", 1) for k, v in enumerate(bad)] + [(None, [1.0, 1.0], 1, "x", 1), (200, [1.0, 1.0], None, "x", 1)]
    good = [(0, [1.0, 1.0], 1, None, None), (1, [0.9, 0.9], 2, "x", 1), (2, [0.5, 0.4], 3, "x", 1), (3, [0.5, 0.4], 4, "x", 1), (7, [0.5], 3, "x", 1), (4, [-0.5, -0.4], 2, "x", 1)]
    got = negatives.prepared(spark.createDataFrame(rows + good, KIND))
    kept = sorted((r["id"], r["label"], list(r["vector"])) for r in got.collect())
    assert kept == [(0, 2, [256, 256]), (1, 2, [230, 230]), (2, 3, [128, 102]), (3, 4, [128, 102]), (4, 2, [-128, -103]), (7, 4, [128]), (101, 3, [])]
    assert rows_of(negatives.mine(got)) == plain(kept)
    assert negatives.mine(negatives.prepared(spark.createDataFrame([], KIND))).count() == 0
    with pytest.raises(ValueError):
        negatives.mine(negatives.prepared(spark.createDataFrame([(1, [3e38], 1, "", 1)], KIND)))
