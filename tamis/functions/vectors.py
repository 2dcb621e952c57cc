"""Vector arithmetic: column expressions that stay in the JVM, and matrices of Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def normalised(v: Column) -> Column:
    """``v / (|v| + 1e-9)`` in doubles."""
    norm = F.sqrt(dot(v, v)) + F.lit(1e-9)
    return F.transform(v, lambda x: x.cast("double") / norm)


def cosine(a: Column, b: Column) -> Column:
    return dot(normalised(a), normalised(b))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def scale(x: Column, lo: float, hi: float) -> Column:
    return clamp01((x - F.lit(float(lo))) / F.lit(hi - lo + 1e-9))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix of doubles; vectors of different lengths, or none, are an error."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if n and (column.null_count or len(flat) % n or (np.diff(column.offsets.to_numpy()) != len(flat) // n).any()):
        raise ValueError("vectors of different lengths")
    return flat.reshape(n, -1)


def units(m: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths plus 1e-9."""
    return m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-9)
