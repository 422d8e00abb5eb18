"""Vector columns: which rows take part, and how tasks see them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, vec_col: str, *columns: Column) -> DataFrame:
    """``columns`` and the vector as ``x array<double>`` of the rows whose vector
    is not null and holds no null or non-finite component."""
    picked = vectors.select(*columns, F.col(vec_col).cast("array<double>").alias("x"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return picked.filter(F.col("x").isNotNull() & whole)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix, shorter ones padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), dtype=flat.dtype)
    ends = np.cumsum(sizes)
    for i, (n, e) in enumerate(zip(sizes, ends)):
        out[i, :n] = flat[e - n:e]
    return out


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, dim = values.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * dim, dim, dtype=np.int32) if dim else
                                    np.zeros(n + 1, dtype=np.int32), pa.array(values.reshape(-1), kind))
