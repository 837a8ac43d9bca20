"""Vectors of an embedding table as whole numbers: what clustering and whitening start from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest size of a whole component: squared distances of 64 such components fit 64 bits, and sums of 2^36 rows.
LARGEST = 1 << 27


def usable(vector: Column) -> Column:
    """True for a vector that isn't null and holds no null, NaN or infinite entry."""
    bad = F.exists(vector, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def whole(vector: Column, scale: int = 256) -> Column:
    """floor(scale * e) of every entry as an array of ints; an error where one is larger than LARGEST."""
    scaled = F.transform(vector, lambda e: F.floor(e.cast("double") * F.lit(float(scale))))
    fits = ~F.exists(vector, lambda e: F.abs(e.cast("double")) > LARGEST / scale)
    return F.when(fits, scaled.cast("array<int>")).otherwise(F.raise_error(F.lit(f"a component is larger than {LARGEST / scale:.0f}")).cast("array<int>"))


def matrix(batch, column: str, dims: int) -> np.ndarray:
    """The (rows, dims) int64 matrix of an Arrow batch's array column."""
    flat = batch.column(column).flatten()
    return np.asarray(flat, dtype=np.int64).reshape(batch.num_rows, dims)
