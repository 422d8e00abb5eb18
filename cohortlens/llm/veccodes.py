"""Vector code compression: product quantisation in exact integer arithmetic.

Components become integers (``floor(scale * x)``) and vectors are cut into
``parts`` equal consecutive parts. Each part position has a codebook of
``entries`` vectors; a vector is stored as the index of the nearest entry of
each part. Codebooks start as the vectors of the smallest ids and are refined
in ``rounds`` passes (nearest entry by squared Euclidean distance, ties to the
lower index; then the floor of the mean of its parts, an unused entry stays).

Nearest entries need the dot products of all parts with all entries. They are
exact: integers are broken into limbs of so few bits that a float64 matrix
product of two limbs stays below 2^53, the products are recombined in int64
(in Python integers where a distance could leave int64), and the first argmin
of ``|c|^2 - 2 x.c`` is the code.

Every pass is one job over a written table: tasks return the sums and counts
of their rows (parts x entries rows each), which Spark adds up; the driver
holds the codebooks only.

Defined results: rows with a null vector or with null or non-finite
components are dropped. Rows without an id are compressed, but start no
codebook. Repeated rows count one by one; equal ids are ordered by their
vectors. With fewer rows than entries the codebooks are shorter. Vectors
whose length is no multiple of ``parts``, or differs, count as padded with
zeros. Components from 2^62 / scale on, and errors that do not fit a long, are
an error. An empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.vectors import lists, matrix, usable
from cohortlens.session import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6


@dataclasses.dataclass
class Codebooks:
    """``books[part]`` is the (entries, width) matrix of a part position."""

    books: list[np.ndarray]
    largest: int            # largest absolute component of the table

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    @property
    def fits(self) -> bool:
        """Every distance and every step towards it fits int64."""
        return 8 * self.width * len(self.books) * self.largest ** 2 < 2**63

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimal numbers with commas."""
        return hashlib.sha256(",".join(str(int(c)) for b in self.books for c in b.reshape(-1)).encode()).hexdigest()

    def decode(self, codes: list[int]) -> list[int]:
        """The integer vector that a code stands for."""
        return [int(c) for book, code in zip(self.books, codes) for c in book[code]]


def limbs(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float matrices whose i-th, times 2^(bits * i), add up to the integers ``a``;
    all are below 2^bits in absolute value."""
    out = []
    while a.size and np.abs(a).max() >= 1 << bits:
        out.append((a & ((1 << bits) - 1)).astype(np.float64))
        a = a >> bits
    return [*out, a.astype(np.float64)]


def dot(x: np.ndarray, c: np.ndarray, fits: bool) -> np.ndarray:
    """All dot products of the rows of two integer matrices, exactly."""
    bits = (53 - max(0, x.shape[1] - 1).bit_length()) // 2
    total = np.zeros((len(x), len(c)), dtype=np.int64 if fits else object)
    columns = [limb.T for limb in limbs(c, bits)]
    for i, left in enumerate(limbs(x, bits)):
        for j, right in enumerate(columns):
            product = (left @ right).astype(np.int64)
            total += (product if fits else product.astype(object)) * (1 << (bits * (i + j)))
    return total


def nearest(x: np.ndarray, book: np.ndarray, fits: bool) -> tuple[np.ndarray, np.ndarray]:
    """(code, squared distance) of each row: the first of the nearest entries."""
    kind = np.int64 if fits else object
    x, book = x.astype(kind), book.astype(kind)
    less = (book * book).sum(axis=1)[None, :] - 2 * dot(x, book, fits)
    code = less.argmin(axis=1)
    return code, (x * x).sum(axis=1) + less[np.arange(len(x)), code]


def _parts(batch: pa.RecordBatch, books: Codebooks) -> np.ndarray:
    """(rows, parts, width) integers of a batch."""
    n, width = len(books.books), books.width
    return matrix(batch.column("v"), n * width).astype(np.int64).reshape(-1, n, width)


def _sums(books: Codebooks):
    """Per task: for each part and entry the rows that have it as nearest, and their sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for batch in batches:
            x = _parts(batch, books)
            for p, book in enumerate(books.books):
                mine = x[:, p] if books.fits else x[:, p].astype(object)
                code, _ = nearest(mine, book, books.fits)
                for e in np.unique(code).tolist():
                    rows = mine[code == e]
                    n, sums = found.get((p, e), (0, [0] * books.width))
                    found[p, e] = (n + len(rows), [a + int(b) for a, b in zip(sums, rows.sum(axis=0))])
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([found[k][0] for k in keys], pa.int64()),
             pa.array([found[k][1] for k in keys], pa.list_(pa.decimal128(38, 0)))], names=["part", "entry", "n", "sums"])
    return run


def integers(vectors: DataFrame, *columns: Column, vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``columns`` and ``v array<long>``, the floors of the scaled components, written once."""
    rows = usable(vectors, vec_col, *columns)
    limit = 2.0 ** 62
    scaled = F.transform("x", lambda c: F.when(F.abs(c * F.lit(float(scale))) < limit, F.floor(c * F.lit(float(scale))))
                         .otherwise(F.raise_error(F.lit("a component is too large to be compressed")).cast("long")))
    return materialize(rows.withColumn("v", scaled).drop("x"), "veccodes-rows")


def fit(rows: DataFrame, id_col: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the integer vectors ``rows`` (from ``integers``); None without any row with an id."""
    facts = rows.agg(F.max(F.size("v")).alias("dim"),
                     F.max(F.array_max(F.transform("v", lambda c: F.abs(c)))).alias("largest")).first()
    seeds = rows.filter(F.col(id_col).isNotNull()).orderBy(id_col, "v").select("v").limit(entries).collect()
    if not seeds:
        return None
    width = max(1, -(-facts["dim"] // parts))
    start = np.zeros((len(seeds), parts * width), dtype=np.int64)
    for i, r in enumerate(seeds):
        start[i, :len(r["v"])] = r["v"]
    books = Codebooks([start[:, p * width:(p + 1) * width].copy() for p in range(parts)], facts["largest"] or 0)
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(
            _sums(books), "part int, entry int, n long, sums array<decimal(38,0)>")
        means = (sums.select("part", "entry", "n", F.posexplode("sums").alias("j", "s")).groupBy("part", "entry", "j")
                 .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
        for r in means:  # parts x entries x width numbers
            books.books[r["part"]][r["entry"], r["j"]] = int(r["s"]) // r["n"]
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """The columns of ``rows`` but ``v``, with ``codes array<int>`` and ``error``, the
    squared distances to the chosen entries summed over the parts."""
    kept = [c for c in rows.columns if c != "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _parts(batch, books)
            codes = np.zeros((len(x), len(books.books)), dtype=np.int32)
            error = np.zeros(len(x), dtype=np.int64 if books.fits else object)
            for p, book in enumerate(books.books):
                codes[:, p], far = nearest(x[:, p], book, books.fits)
                error = error + far
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), lists(codes, pa.int32()), pa.array(error.tolist(), pa.int64())],
                names=[*kept, "codes", "error"])

    schema = T.StructType([rows.schema[c] for c in kept] + [
        T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    return rows.mapInArrow(run, schema)
