"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# a side is broadcast only when it was counted and holds at most this many rows
BROADCAST_ROWS = 50_000

#: the characters that separate words: space and U+0009 to U+000D
SPACES = " \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened by underscores until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def attach(big: DataFrame, small: DataFrame, on: str, small_rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Left join of ``small`` (one row per ``on``, null allowed as a key).

    ``small_rows`` is its counted size: up to ``limit`` rows it is broadcast, beyond
    that both sides are shuffled once by key, and AQE splits the tasks of hot keys.
    """
    [key] = free_names(big, "__key")
    small = small.withColumnRenamed(on, key)
    if small_rows <= limit:
        small = F.broadcast(small)
    return big.join(small, F.col(on).eqNullSafe(F.col(key)), "left").drop(key)


def token_lists(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Words of every text: (offsets of length n + 1, flat array of words).

    Words are the maximal runs without the characters of ``SPACES``; a null
    text has none. With ``lower``, A-Z become a-z and nothing else changes.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(1, dtype=np.int64), pa.array([], type=pa.large_string())
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    keep = pc.greater(pc.binary_length(flat), 0)
    ends = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False))))
    offsets = split.offsets.to_numpy()
    words = flat.filter(keep)
    # the words, not the texts: Arrow lower-cases wrong bytes of a slice that was cast
    return ends[offsets - offsets[0]].astype(np.int64), pc.ascii_lower(words) if lower else words


def slices(batches: Iterator[pa.RecordBatch], size_of: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one holds about ``limit`` bytes of column ``size_of``
    (a single longer value stays whole)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(size_of)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if len(sizes) > start:
            yield batch.slice(start)


def longs(col: Column) -> Column:
    return col.cast("long")
