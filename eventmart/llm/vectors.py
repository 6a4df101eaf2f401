"""Columns of vectors: which are usable, scaled to integers, and read as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for a vector that is there and whose components are all finite numbers."""
    bad = F.exists(
        vector,
        lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == np.inf),
    )
    return F.col(vector).isNotNull() & ~bad


def scaled(vector: str, factor: int, shift: int = 0) -> Column:
    """floor(factor * c) + shift of each component, as array<bigint>."""
    return F.transform(
        vector,
        lambda c: F.floor(F.lit(float(factor)) * c.cast("double")).cast("bigint") + F.lit(shift),
    )


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of ``dims`` numbers without nulls as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)
