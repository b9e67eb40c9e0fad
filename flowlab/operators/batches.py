"""Numeric rows as one array column, so that an Arrow batch is a matrix without copies."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def packed(values: Sequence[Column]) -> Column:
    """The values as an array of doubles, NULL as NaN."""
    return F.array(*[F.coalesce(v.cast("double"), F.lit(float("nan"))) for v in values])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a packed column as a rows x width matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
