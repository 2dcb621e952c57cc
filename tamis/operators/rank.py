"""Places in an order, of collections of any size: no window or task holds a collection that has no bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.storage import materialise

_AT, _RUN, _BASE, _FIRST = "__at", "__run", "__base", "__first"


def placed(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "place", total: str | None = None) -> DataFrame:
    """``df`` with each row's place in its collection, from 0, in the given order; with ``total`` also the collection's rows.

    Rows are dealt by ranges of (keys, order), sorted, numbered as they stand in their range and written once. The ranges'
    counts for each collection, a few numbers for each range, give each range its first place; a join by (keys, range) adds
    it. A collection is spread over all tasks, however large its share; rows that are equal in all of ``order`` share a
    range, so callers end the order with what tells rows apart. Null keys are a collection of their own, and nulls come
    first unless the order says otherwise. The result is a plan over the written rows."""
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = materialise(dealt.withColumn(_AT, F.monotonically_increasing_id()), "places").withColumn(_RUN, F.shiftright(_AT, 33))
    runs = rows.groupBy(*keys, _RUN).agg(F.min(_AT).alias(_FIRST), F.count("*").alias("__n"))
    of_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    before = F.coalesce(F.sum("__n").over(of_key.orderBy(_RUN).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col(_RUN).alias("__r"), (before - F.col(_FIRST)).alias(_BASE), F.sum("__n").over(of_key).alias("__t"))
    same = F.col(_RUN) == F.col("__r")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    out = rows.join(runs, same)
    found = [(F.col(_AT) + F.col(_BASE)).alias(name)]
    return out.select(*df.columns, *found, *([F.col("__t").alias(total)] if total else []))


#: Rows of a collection up to which a window numbers them in one task.
WINDOW = 100_000


def ordered(df: DataFrame, key: str, order: list[str | Column], name: str, most: int | None = None) -> DataFrame:
    """``df`` with each row's place, from 1, in its collection: by a window where callers know that a collection has at
    most ``most`` rows and that is no more than ``WINDOW``, else by ranges."""
    if most is not None and most <= WINDOW:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))
    return placed(df, [key], order, name).withColumn(name, F.col(name) + 1)
