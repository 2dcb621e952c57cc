"""Connected components of graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tamis.storage import discard, materialise, scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest node that it can reach. Nodes are of any type
    that has an order.

    Alternating large-star and small-star contractions (Kiveris et al., SoCC 2014), until a round changes nothing, which
    takes about the logarithm of the longest path in rounds. Each round is two aggregations and two joins over edges that
    never grow in number, written to the shared folder in place of the last one; a node with very many neighbours costs a
    split join, not one task. The driver sees two numbers a round.
    """
    spark = edges.sparkSession
    path, seen = scratch(spark, "components"), None
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialise(now, "components", path=path)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large_path = scratch(spark, "components")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "components", path=large_path)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = (
            met.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        watch = Observation()
        small = small.observe(watch, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").bitwiseAND((1 << 30) - 1)).alias("h"))
        small_path = scratch(spark, "components")
        now = materialise(small, "components", path=small_path)
        got = (watch.get["n"], watch.get["h"])
        discard(spark, path)
        discard(spark, large_path)
        path = small_path
        if got == seen:
            break
        seen = got
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
