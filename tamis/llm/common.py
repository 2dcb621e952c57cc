"""What the corpus operators share: Arrow mapping and key filters, besides the library's storage and components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators.graph import connected_components
from tamis.session import reach
from tamis.storage import materialise, scratch

__all__ = ["KeyFilter", "arrow_map", "batches_of", "connected_components", "materialise", "scratch", "slices", "table", "texts", "utf8"]


def arrow_map(df: DataFrame, columns: list, schema, make: Callable[[], Callable[[pa.RecordBatch], Iterator]]) -> DataFrame:
    """``mapInArrow`` over some columns; ``make`` builds the batch function once in each task."""

    def run(batches):
        step = make()
        for batch in batches:
            for small in slices(batch):
                yield from step(small)

    reach(df.sparkSession)
    named = [f"`{c}`" if isinstance(c, str) else c for c in columns]
    return df.select(*named).mapInArrow(run, schema)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, jobs hand Python at most so many rows at once, for columns of large values."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batch: pa.RecordBatch, rows: int = 512, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of at most ``rows`` rows, fewer where their bytes pass ``most``; no row is split or lost."""
    n = batch.num_rows
    if n <= rows and batch.nbytes <= most:
        if n:
            yield batch
        return
    step = max(1, min(rows, int(n * most / max(batch.nbytes, 1))))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A string column as Python strings; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.large_binary()).to_pylist()]


class KeyFilter:
    """A set of keys as hashed bits of a fixed number, so its size has a bound however many keys there are. Absent keys
    may pass, present ones always do; a full filter lets every key through, which costs a shuffle and changes no result."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @classmethod
    def of(cls, keys: DataFrame, n: int) -> KeyFilter:
        """Of some ``n`` non-negative ``keys(key)``: two places for each among sixteen bits, 2 ** 27 (16 MB) at most."""
        bits = min(27, max(20, (16 * n).bit_length()))
        places = [f"shiftright(((key & 2147483647) * {a}L) ^ (shiftright(key, 31) * {b}L), {s}) & {(1 << bits) - 1}L" for a, b, s in _MIX]
        words = keys.select(F.explode(F.array(*map(F.expr, places))).alias("at")).groupBy(F.expr("shiftright(at, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, int(at & 63)))").alias("b"))
        got = words.toArrow()  # at most 2 ** (bits - 6) rows
        out = np.zeros(1 << (bits - 6), np.int64)
        out[got.column("w").to_numpy()] = got.column("b").to_numpy()
        return cls(out, bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        low, high, out = keys & 0x7FFFFFFF, keys >> 31, True
        for a, b, s in _MIX:
            at = ((low * a ^ high * b) >> s) & ((1 << self.bits) - 1)
            out = out & ((self.words[at >> 6] >> (at & 63)) & 1 == 1)
        return out


#: Multipliers of a key's lower 31 and other bits, and the shift of their mixture, for either place.
_MIX = ((0x9E3779B1, 0x85EBCA77, 7), (0xC2B2AE35, 0x27D4EB2F, 4))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
