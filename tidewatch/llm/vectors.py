"""What the operators on embeddings share: which vectors count, equal lengths, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(vector: str) -> Column:
    """True for a vector without null or non-finite entries; false for a null vector."""
    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def longest(rows: DataFrame, vector: str) -> int:
    """The largest number of entries, 0 without rows."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def padded(vector: str, length: int) -> Column:
    """The vector, filled up with zeros to `length` entries; vectors that have them stay as they are."""
    missing = F.lit(length) - F.size(vector)
    zeros = F.transform(F.sequence(F.lit(1), missing), lambda _: F.lit(0))
    return F.when(missing > 0, F.concat(F.col(vector), zeros)).otherwise(F.col(vector))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A column of equally long lists as a matrix with one row each."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    return values.reshape(len(column), length)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a column of lists."""
    offsets = np.arange(0, values.size + 1, values.shape[1] or 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))
