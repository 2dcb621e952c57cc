"""Frames that arrive late against the fold of a batch."""

import numpy as np
from pyspark.sql import functions as F

from tamis.catalog import CFG
from tamis.operators import folds, scoring
from tamis.sources import frames
from tamis.streaming import novelty


def test_shuffled_stream_equals_the_fold(spark, sf_dir, tmp_path):
    view = frames.light_view(spark, sf_dir).withColumn("seen_at", F.timestamp_seconds(F.col("idx").cast("double")))
    n = view.count()
    rng = np.random.default_rng(0)
    late = rng.permutation(n).tolist()
    files = [late[k::4] for k in range(4)]  # any order at all within 10,000 seconds
    for k, ids in enumerate(files):
        view.where(F.col("idx").isin(ids)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    end = view.limit(1).withColumn("video_id", F.lit("end")).withColumn("sharpness", F.lit(1e9)).withColumn("contrast", F.lit(1e9)).withColumn("seen_at", F.timestamp_seconds(F.lit(1e6)))
    end.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stale = view.orderBy("idx").limit(3).withColumn("sharpness", F.lit(1e9)).withColumn("contrast", F.lit(1e9))
    stale.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", novelty.STATE_STORE)
    try:
        stream = spark.readStream.schema(view.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        scored = novelty.score_late_stream(stream, CFG, delay="10000 seconds")
        query = scored.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    rows = spark.read.parquet(str(tmp_path / "out")).where("video_id <> 'end'")
    batch = folds.score_frames(scoring.prefilter(view, CFG), CFG)
    want = {(r["video_id"], r["idx"]): round(r["content_novelty"], 9) for r in batch.collect()}
    assert {(r["video_id"], r["idx"]): round(r["content_novelty"], 9) for r in rows.where("NOT late").collect()} == want
    late = [r["idx"] for r in rows.where("late").collect()]
    assert rows.count() == len(want) + len(late) and set(late) <= {0, 1, 2}
    assert len(late) + dropped == 3
