"""Every query of the engine against its SQL in DuckDB, and the image pipeline against a plain version."""

import duckdb
import numpy as np
import pytest

from tamis import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, duck, name):
    got = catalog.queries()[name](spark, sf_dir).toPandas()
    want = duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True).astype(str) for x in (got, want))
    assert len(a) == len(b) and len(a) > 0
    assert a.equals(b)


def test_image_pipeline(spark, sf_dir):
    got = catalog.curate_images(spark, sf_dir).toPandas()
    pre = catalog._image(spark, sf_dir).toPandas()
    pre = pre[(pre.sharpness >= 19500.5) & (pre.contrast >= 31.01)]
    c = catalog.IMAGE_CFG
    for video, group in pre.groupby("video_id"):
        group = group.sort_values("idx").reset_index(drop=True)
        unit = np.stack(group.embed).astype(float)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True) + 1e-9
        kept, novelty = [], []
        for v in unit:
            n = min(1.0, max(0.0, 1 - max((float(p @ v) for p in kept[-c.novelty_memory :]), default=0.0))) if kept else 1.0
            novelty.append(n)
            if n > c.novelty_threshold:
                kept.append(v)

        def scaled(x, lo, hi):
            return np.clip((x - lo) / (hi - lo + 1e-9), 0, 1)

        q = 0.35 * scaled(group.sharpness, *c.sharpness_range) + 0.30 * scaled(group.contrast, *c.contrast_range) + 0.25 * group.exposure_score + 0.10 * group.noise_score
        score = dict(zip(group.idx, 0.5 * q + 0.5 * np.array(novelty), strict=True))
        mine = got[got.video_id == video].sort_values("final_ord")
        assert len(mine) == min(catalog.SIZE, len(group))
        assert mine.idx.is_unique
        assert np.allclose(mine.ml_score, [score[i] for i in mine.idx], atol=2e-6)
        assert (np.diff(mine.ml_score) <= 1e-9).all()
