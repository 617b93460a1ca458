"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
