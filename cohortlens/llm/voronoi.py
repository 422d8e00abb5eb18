"""Exact top-k search by a Voronoi join.

Scores are integer inner products. Adding the coordinate sqrt(M - |x|^2) to
every candidate (M: the largest |x|^2; 0 for queries) turns the largest inner
products into the smallest Euclidean distances, so metric bounds hold:
d(q, x)^2 = |q|^2 + M - 2 q.x.

1. Pivots: ``pivots`` candidates of smallest hash (a fixed number).
2. Every candidate goes to the cell of its nearest pivot; a cell's summary is
   its size, its least and largest pivot distance and its k smallest ones.
3. A query's bound t on the distance of its k-th neighbour follows from the
   summaries (triangle inequality) and from the pivots, which are candidates
   themselves. It needs of a cell only the ring |d(q, p) - d(x, p)| <= t, and
   nothing if the plane between two pivots is farther away than t.
4. Queries are grouped by nearest pivot, in blocks of at most ``QUERY_BLOCK``;
   a candidate is sent to the blocks that have it in a ring.
5. Each (block, part of the candidates) is solved by itself, and the partial
   lists are merged. Parts are dealt by hash, so a cell with a third of all
   rows is spread evenly.

Defined results: rows without an id, with a null vector, or with null or
non-finite components take no part. Shorter vectors count as padded with
zeros. Every row but those with the query's own id is a candidate, repeated
rows one by one; a query repeated with the same vector is answered once. A
score that does not fit a long is an error. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import BROADCAST_ROWS
from cohortlens.session import materialize

PIVOTS = 128
QUERY_BLOCK = 8192      # queries that are solved together
PART_ROWS = 65_536      # candidates that are solved together
LEAST_PARTS = 24        # parts for smaller tables, so that all cores work
LEAST_PART_ROWS = 2048
MAX_OWN_ROWS = 1000     # rows of one query id that the summaries make room for


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the rows that take part."""
    picked = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                            F.col(vec_col).cast("array<double>").alias("x"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return picked.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & whole).select(
        "vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), dtype=np.int64)
    ends = np.cumsum(sizes)
    for i, (n, e) in enumerate(zip(sizes, ends)):
        out[i, :n] = flat[e - n:e]
    return out


class _Pivots:
    """Pivot vectors and distances to them in the lifted space."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, largest: float):
        self.v, self.ids, self.m = vectors.astype(np.float64), ids, largest
        self.lift = np.sqrt(np.maximum(0, largest - (self.v ** 2).sum(1)))
        gram = self.v @ self.v.T + np.outer(self.lift, self.lift)
        self.between = np.sqrt(np.maximum(0, 2 * largest - 2 * gram))
        self.slack = 1e-6 * math.sqrt(largest) + 1e-9  # for rounding

    def candidates(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        lift = np.sqrt(np.maximum(0, self.m - (x ** 2).sum(1)))
        return np.sqrt(np.maximum(0, 2 * self.m - 2 * (x @ self.v.T + np.outer(lift, self.lift))))

    def queries(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        return np.sqrt(np.maximum(0, (q ** 2).sum(1)[:, None] + self.m - 2 * q @ self.v.T))


def _assign(pivots: _Pivots, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = pivots.candidates(_matrix(batch.column("v"), dim))
            cell = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(cell.astype(np.int32)),
                 pa.array(d[np.arange(len(d)), cell])], names=["vec_id", "v", "cell", "dist"])
    return run


def query_rings(pivots: _Pivots, d: np.ndarray, own: np.ndarray, low, high, nearest, k: int):
    """For each query and cell: is it needed, and the ring (lo, hi) of pivot distances.

    d: query-pivot distances; own: query ids; low, high: least and largest
    distance in each cell; nearest: (cells, n) smallest distances, inf if fewer.
    """
    through = np.sort((d[:, :, None] + nearest[None]).reshape(len(d), -1), axis=1)
    bound = through[:, nearest.shape[1] - 1]  # k + own rows: enough without the query's own
    direct = np.where(pivots.ids[None, :] == own[:, None], np.inf, d)
    if direct.shape[1] >= k:
        bound = np.minimum(bound, np.sort(direct, axis=1)[:, k - 1])
    bound = (bound + pivots.slack)[:, None]
    lo, hi = np.maximum(d - bound, low), np.minimum(d + bound, high)
    needed = (lo <= hi) & np.isfinite(high)
    home = d.argmin(axis=1)
    apart = pivots.between[home]              # (queries, cells)
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (d ** 2 - d[np.arange(len(d)), home][:, None] ** 2) / (2 * apart)
    needed &= ~(np.where(apart > 0, plane, 0) > bound)
    return needed, lo, hi


def best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int):
    """The k best candidates of each query: (query row, candidate row, score), ties to smaller ids."""
    order = np.argsort(x_ids, kind="stable")
    x, x_ids = x[order], x_ids[order]
    span = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    kind = np.float64 if span < 2**53 else object
    xt = x.astype(kind).T
    step = max(1, (1 << 24) // max(1, len(x)))
    rows, cols, scores = [], [], []
    for i in range(0, len(q), step):
        s = q[i:i + step].astype(kind) @ xt
        for r in range(len(s)):
            line = s[r]
            mine = np.flatnonzero(x_ids != q_ids[i + r])
            if len(mine) > k:
                part = line[mine]
                least = np.sort(part)[-k] if kind is object else np.partition(part, len(part) - k)[len(part) - k]
                mine = mine[part >= least]
            top = mine[np.argsort(-line[mine], kind="stable")[:k]]  # ids ascend, so ties are in order
            rows += [i + r] * len(top)
            cols += order[top].tolist()
            scores += [int(v) for v in line[top]]
    return rows, cols, scores


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 1024, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score long"
    rows = scaled(vectors, id_col, vec_col, scale)
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.max(norm).alias("m"),
                     F.sum(is_query.cast("long")).alias("q")).first()
    if not facts["n"] or not facts["q"]:
        return spark.createDataFrame([], result)
    dim, n = facts["dim"], facts["n"]
    seeds = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).collect()
    points = np.zeros((len(seeds), dim))
    for i, r in enumerate(seeds):
        points[i, :len(r["v"])] = r["v"]
    table = _Pivots(points, np.array([r["vec_id"] for r in seeds]), float(facts["m"]))

    cells = materialize(rows.mapInArrow(_assign(table, dim), "vec_id long, v array<long>, cell int, dist double"),
                        "knn-cells")
    queries = cells.filter(is_query)
    own_rows = queries.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    near = k + min(own_rows, MAX_OWN_ROWS)
    low, high = np.full(len(seeds), np.inf), np.full(len(seeds), -np.inf)
    nearest = np.full((len(seeds), near), np.inf)
    for r in cells.groupBy("cell").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi")).collect():
        low[r["cell"]], high[r["cell"]] = r["lo"], r["hi"]
    place = F.row_number().over(Window.partitionBy("cell").orderBy("dist"))
    for r in cells.select("cell", "dist", place.alias("i")).filter(F.col("i") <= near).collect():
        nearest[r["cell"], r["i"] - 1] = r["dist"]
    if own_rows > MAX_OWN_ROWS:
        nearest[:] = np.inf

    # query blocks: neighbouring pivots together, a crowded one in several blocks
    asked = queries.select("vec_id", "v").distinct()
    home = {}

    def homes(batches):
        for batch in batches:
            d = table.queries(_matrix(batch.column("v"), dim))
            cell = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"),
                                              pa.array(cell.astype(np.int32))], names=["vec_id", "v", "cell"])

    asked = materialize(asked.mapInArrow(homes, "vec_id long, v array<long>, cell int"), "knn-queries")
    block, room = 0, QUERY_BLOCK
    sizes = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
    for cell in np.argsort(table.between[0], kind="stable").tolist():
        if size := sizes.get(cell, 0):
            if size > room:
                block, room = block + (room < QUERY_BLOCK), QUERY_BLOCK
            salts = math.ceil(size / QUERY_BLOCK)
            home[cell] = (block, salts)
            block, room = (block + salts, QUERY_BLOCK) if salts > 1 else (block, room - size)

    def needs(batches):
        for batch in batches:
            q, ids = _matrix(batch.column("v"), dim), batch.column("vec_id").to_numpy()
            cell = batch.column("cell").to_numpy()
            groups = np.array([home[c][0] + (hash(int(i)) // 100 % home[c][1]) for c, i in zip(cell, ids)], dtype=np.int32)
            for s in range(0, len(q), 256):
                e = slice(s, s + 256)
                needed, lo, hi = query_rings(table, table.queries(q[e]), ids[e], low, high, nearest, k)
                i, j = np.nonzero(needed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(groups[e][i]), pa.array(j.astype(np.int32)), pa.array(lo[i, j]), pa.array(hi[i, j])],
                    names=["block", "ring_cell", "lo", "hi"])

    def blocks(batches):
        for batch in batches:
            cell, ids = batch.column("cell").to_numpy(), batch.column("vec_id").to_numpy()
            groups = [home[c][0] + (hash(int(i)) // 100 % home[c][1]) for c, i in zip(cell, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int32()), batch.column("vec_id"), batch.column("v")],
                                             names=["block", "query_id", "q"])

    rings = materialize(
        asked.mapInArrow(needs, "block int, ring_cell int, lo double, hi double").groupBy("block", "ring_cell")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "knn-rings")
    parts = max(math.ceil(n / PART_ROWS), min(LEAST_PARTS, math.ceil(n / LEAST_PART_ROWS)))
    data = cells.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int"))
    inside = (F.col("cell") == F.col("ring_cell")) & F.col("dist").between(F.col("lo"), F.col("hi"))
    if rings.count() <= BROADCAST_ROWS:
        sent = data.join(F.broadcast(rings), inside)
    else:  # deal a crowded cell's rows by part as well
        dealt = rings.withColumn("ring_part", F.explode(F.sequence(F.lit(0), F.lit(63))))
        sent = data.join(dealt, inside & (F.pmod("part", F.lit(64)) == F.col("ring_part")))
    sent = sent.select("block", "part", "vec_id", "v")
    asking = asked.mapInArrow(blocks, "block int, query_id long, q array<long>").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, q_ids = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy()
        rows_, cols, scores = best(_matrix(right.column("q"), dim), q_ids, _matrix(left.column("v"), dim), ids, k)
        return pa.table([right.column("query_id").take(pa.array(rows_, pa.int64())),
                         right.column("q").take(pa.array(rows_, pa.int64())),
                         left.column("vec_id").take(pa.array(cols, pa.int64())), pa.array(scores, pa.int64())],
                        names=["query_id", "q", "vec_id", "score"])

    found = sent.groupBy("block", "part").cogroup(asking.groupBy("block", "part")).applyInArrow(
        solve, "query_id long, q array<long>, vec_id long, score long")
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return (found.select("query_id", F.xxhash64("q").alias("row"), "vec_id", "score")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
