"""Exact quantiles of collections of any size, by ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.storage import materialise


def exact_quantile(df: DataFrame, key: str, value: str, q: float, name: str) -> DataFrame:
    """(key, name): the linearly interpolated ``q``-quantile of the values that are not null in each collection.

    Counts of equal values are dealt by ranges of (key, value) and written once; the ranges' sums give each range its first
    rank, and the two ranks wanted are picked in the ranges that hold them. No task or buffer holds a collection."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(key).alias("k"), F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    runs = materialise(counts.repartitionByRange("k", "v").withColumn("pid", F.spark_partition_id()), "ranges")
    of_key = Window.partitionBy("k")
    sums = runs.groupBy("k", "pid").agg(F.sum("n").alias("s"))  # a row for each range of a collection
    sums = sums.select(
        "k",
        "pid",
        F.coalesce(F.sum("s").over(of_key.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        (F.lit(float(q)) * (F.sum("s").over(of_key) - 1)).alias("at"),
        F.col("s"),
    )
    wanted = sums.where("floor(at) < base + s AND ceil(at) >= base")
    ranked = runs.join(wanted, ["k", "pid"]).withColumn("up_to", F.col("base") + F.sum("n").over(Window.partitionBy("k", "pid").orderBy("v")))
    picked = [F.max(F.expr(f"CASE WHEN {f}(at) < up_to AND {f}(at) >= up_to - n THEN v END")).alias(f) for f in ("floor", "ceil")]
    got = ranked.groupBy("k", "at").agg(*picked)
    low, high, at = F.col("floor"), F.col("ceil"), F.col("at")
    between = F.when(F.floor("at") == F.ceil("at"), low).otherwise((F.ceil("at") - at) * low + (at - F.floor("at")) * high)
    return got.select(F.col("k").alias(key), between.alias(name))
