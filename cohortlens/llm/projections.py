"""Approximate nearest neighbours by low-dimensional stable projections.

Unit vectors are projected on ``dims`` Gaussian directions. The squared
distance of two projected vectors, over their true squared distance, then has a
chi-square distribution with ``dims`` degrees of freedom. Projected neighbours
of a query are therefore verified by rising projected distance, until the next
one is so far away that a vector nearer than the k-th best found would show
such a projected distance with a chance of at most ``1 - confidence``: the search
ends where (projected distance)^2 >= quantile * (k-th true distance)^2.

The projected vectors are indexed by a kd-tree in two levels:

1. Its upper levels are grown on a sample (``SAMPLE`` rows at most, a documented
   bound) and only decide the cells; every row is put into its cell. A cell's
   box, and a crowded cell's number of parts of about ``PART_ROWS`` rows, come
   from counts of all rows.
2. A (cell, part) with a block of queries is one group: its task grows the
   lower levels over the rows of the part and runs the search leaf by leaf.

Queries search their own cell first. The k-th distance found there bounds
the second round, in which a query goes only to the cells whose box the
stopping test does not rule out, and stops there by the same test.

Scores are cosines in double precision over the original vectors. Each
vector is scaled by a power of two, so that no square overflows.

Defined results: rows without an id, with a null or zero vector, or with null
or non-finite components take no part. Shorter vectors count as padded with
zeros. Every row but those with the query's own id is a candidate, repeated
rows one by one; a query repeated with the same vector is answered once. Ties
go to the smaller id. An empty table gives an empty result. Other columns are
ignored. The seed fixes the projections, so results do not depend on chance,
only (within the confidence) on how rows are dealt to parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.vectors import lists, matrix, usable
from cohortlens.session import materialize

DIMS = 16
CONFIDENCE = 0.96
SAMPLE = 16_384         # rows that the upper levels of the tree are grown on
PART_ROWS = 4096        # rows that are searched together
QUERY_BLOCK = 1024      # queries that search them together
LEAF = 32               # rows of a leaf of the lower levels
STEP = 8                # leaves that are verified at a time
SEED = 20


def chi_square_quantile(p: float, dims: int) -> float:
    """The value below which a chi-square variable with ``dims`` (even) degrees stays with chance ``p``."""
    if dims % 2 or not 0 < p < 1:
        raise ValueError("dims must be even and the confidence between 0 and 1")

    def chance(x: float) -> float:
        term, total = 1.0, 0.0
        for i in range(dims // 2):
            total += term
            term *= x / 2 / (i + 1)
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while chance(high) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chance(mid) < p else (low, mid)
    return high


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times a power of two (largest component near 1), and their lengths."""
    exponent = np.frexp(np.abs(x).max(axis=1, initial=0))[1]
    x = np.ldexp(x, -exponent[:, None])
    return x, np.sqrt((x * x).sum(axis=1))


# --- kd-trees ------------------------------------------------------------------------

class Upper:
    """The upper levels: cuts along the widest dimension at the median of the sample."""

    def __init__(self, sample: np.ndarray, leaf_rows: int):
        self.cuts: list[tuple[int, float, int, int]] = []   # dimension, value, node below, node above
        self.cells = 0
        self.root = self._grow(sample, leaf_rows)

    def _grow(self, rows: np.ndarray, leaf_rows: int) -> int:
        """The node of these rows: a cut's number, or -1 - cell."""
        if len(rows) > leaf_rows:
            spread = np.ptp(rows, axis=0)
            dim = int(spread.argmax())
            if spread[dim] > 0:
                values = np.sort(rows[:, dim])
                value = values[len(values) // 2]
                if value == values[0]:
                    value = values[np.searchsorted(values, value, side="right")]
                number = len(self.cuts)
                self.cuts.append((dim, float(value), 0, 0))
                below = rows[:, dim] < value
                self.cuts[number] = (dim, float(value), self._grow(rows[below], leaf_rows),
                                     self._grow(rows[~below], leaf_rows))
                return number
        self.cells += 1
        return -self.cells

    def cell(self, y: np.ndarray) -> np.ndarray:
        out = np.zeros(len(y), dtype=np.int32)
        todo = [(self.root, np.arange(len(y)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                dim, value, low, high = self.cuts[node]
                below = y[rows, dim] < value
                todo += [(low, rows[below]), (high, rows[~below])]
        return out


class Lower:
    """The lower levels over the rows of a part: leaves of at most ``LEAF`` rows with their boxes."""

    def __init__(self, y: np.ndarray):
        self.y = y
        leaves, todo = [], [np.arange(len(y))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            part = y[rows]
            dim, half = int(np.ptp(part, axis=0).argmax()), len(rows) // 2
            order = rows[np.argpartition(part[:, dim], half)]
            todo += [order[:half], order[half:]]
        self.leaves = leaves
        self.low = np.array([y[rows].min(axis=0) for rows in leaves])
        self.high = np.array([y[rows].max(axis=0) for rows in leaves])

    def gaps(self, y: np.ndarray) -> np.ndarray:
        """Squared distance of a projected query to each leaf's box."""
        return box_gaps(y[None, :], self.low, self.high)[0]


def box_gaps(y: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances (rows, boxes)."""
    out = np.zeros((len(y), len(low)))
    for d in range(y.shape[1]):
        gap = np.maximum(0, np.maximum(low[None, :, d] - y[:, None, d], y[:, None, d] - high[None, :, d]))
        out += gap * gap
    return out


SLACK = 1e-9    # for rounding: equal vectors may project a little apart


def search(tree: Lower, x: np.ndarray, length: np.ndarray, ids: np.ndarray, q: np.ndarray, q_length: float,
           q_y: np.ndarray, own: int, k: int, bound: float, quantile: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, score) of the k best found; ``bound`` is a known squared distance of the k-th best."""
    gaps = tree.gaps(q_y)
    order = np.argsort(gaps)
    rows, scores = np.zeros(0, np.int64), np.zeros(0)
    for at in range(0, len(order), STEP):
        if gaps[order[at]] >= quantile * bound + SLACK:
            break       # the stopping test holds for all that is left
        near = np.concatenate([tree.leaves[leaf] for leaf in order[at:at + STEP]])
        apart = tree.y[near] - q_y
        near = near[((apart * apart).sum(axis=1) < quantile * bound + SLACK) & (ids[near] != own)]
        if not len(near):
            continue
        cosine = (x[near] * q).sum(axis=1) / (length[near] * q_length)
        rows, scores = np.concatenate((rows, near)), np.concatenate((scores, cosine))
        best = np.lexsort((ids[rows], -scores))[:k]
        rows, scores = rows[best], scores[best]
        if len(rows) == k:
            bound = min(bound, max(0.0, 2 - 2 * scores[-1]))
    return rows, scores


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            dims: int = DIMS, confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest cosines found for each query.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, vec_col, F.col(id_col).cast("long").alias("vec_id")).filter(
        F.col("vec_id").isNotNull() & F.exists("x", lambda c: c != 0))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dim"),
                     F.sum(is_query.cast("long")).alias("q")).first()
    if not facts["n"] or not facts["q"]:
        return spark.createDataFrame([], result)
    n, dim = facts["n"], facts["dim"]
    quantile = chi_square_quantile(confidence, dims)
    directions = np.random.default_rng(SEED).normal(size=(dim, dims))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, length = scaled(matrix(batch.column("x"), dim))
            y = (x / length[:, None]) @ directions if len(x) else np.zeros((0, dims))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists(y, pa.float64())], names=["vec_id", "x", "y"])

    projected = rows.mapInArrow(project, "vec_id long, x array<double>, y array<double>")
    share = max(1, math.ceil(2**31 * min(1.0, SAMPLE / n)))
    sample = projected.filter(F.pmod(F.xxhash64("vec_id", "x"), F.lit(2**31)) < share).select("y").limit(2 * SAMPLE)
    points = matrix(sample.toArrow().column("y"), dims)
    upper = Upper(points, max(8, len(points) * PART_ROWS // n))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in project(batches):
            cell = upper.cell(matrix(batch.column("y"), dims))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["vec_id", "x", "y", "cell"])

    # written with a row number, so that equal rows can be dealt to different parts
    index = materialize(rows.mapInArrow(place, "vec_id long, x array<double>, y array<double>, cell int")
                        .withColumn("number", F.monotonically_increasing_id()), "projections-index")
    edges = [x for j in range(dims) for x in (F.min(F.col("y")[j]).alias(f"low{j}"), F.max(F.col("y")[j]).alias(f"high{j}"))]
    boxes = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *edges).orderBy("cell").collect()  # <= SAMPLE / 8
    cells = np.array([r["cell"] for r in boxes], dtype=np.int32)
    low = np.array([[r[f"low{j}"] for j in range(dims)] for r in boxes])
    high = np.array([[r[f"high{j}"] for j in range(dims)] for r in boxes])
    parts = spark.createDataFrame([(int(r["cell"]), math.ceil(r["n"] / PART_ROWS)) for r in boxes], "cell int, parts int")

    asked = materialize(index.filter(is_query).groupBy("vec_id", "x").agg(F.first("y").alias("y"), F.first("cell").alias("cell"))
                        .select(F.col("vec_id").alias("query_id"), F.xxhash64("x").alias("row"), F.col("x").alias("q"),
                                F.col("y").alias("q_y"), "cell"), "projections-queries")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        x, length = scaled(matrix(left.column("x"), dim))
        ids, y = left.column("vec_id").to_numpy(), matrix(left.column("y"), dims)
        q, q_length = scaled(matrix(right.column("q"), dim))
        q_y, own, bound = (matrix(right.column("q_y"), dims), right.column("query_id").to_numpy(),
                           right.column("bound").to_numpy())
        asker, found, scores = [], [], []
        if len(x):
            tree = Lower(y)
            for i in range(len(q)):
                r, s = search(tree, x, length, ids, q[i], q_length[i], q_y[i], own[i], k, bound[i], quantile)
                asker.append(np.full(len(r), i))
                found.append(r)
                scores.append(s)
        at = pa.array(np.concatenate([*asker, np.zeros(0, np.int64)]).astype(np.int64))
        return pa.table([right.column("query_id").take(at), right.column("row").take(at),
                         left.column("vec_id").take(pa.array(np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64))),
                         pa.array(np.concatenate([*scores, np.zeros(0)]))], names=["query_id", "row", "vec_id", "score"])

    def visit(queries: DataFrame) -> DataFrame:
        """The k best that each (query, cell) finds."""
        plan = parts.join(queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")),
                          "cell")
        plan = F.broadcast(materialize(plan, "projections-plan"))   # at most one row per cell
        data = index.join(plan, "cell").select(
            "cell", F.pmod("number", "parts").cast("int").alias("part"), "vec_id", "x", "y",
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        sent = queries.join(plan, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "query_id", "row", "q", "q_y", "bound",
            F.pmod(F.xxhash64("query_id", "row"), "blocks").cast("int").alias("block"))
        keys = ["cell", "part", "block"]
        return data.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(
            solve, "query_id long, row long, vec_id long, score double")

    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    home = materialize(best(visit(asked.withColumn("bound", F.lit(float("inf"))))), "projections-home")
    bounds = home.groupBy("query_id", "row").agg(
        F.when(F.count(F.lit(1)) == k, F.greatest(F.lit(0.0), 2 - 2 * F.min("score"))).alias("bound"))
    bounded = asked.join(bounds, ["query_id", "row"], "left").na.fill(float("inf"), ["bound"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, bound = matrix(batch.column("q_y"), dims), batch.column("bound").to_numpy()
            own = batch.column("cell").to_numpy()
            for s in range(0, batch.num_rows, 64):
                e = slice(s, s + 64)
                needed = box_gaps(y[e], low, high) < quantile * bound[e][:, None] + SLACK
                needed &= cells[None, :] != own[e][:, None]
                i, j = np.nonzero(needed)
                taken = batch.slice(s, 64).take(pa.array(i))
                yield pa.RecordBatch.from_arrays(
                    [*(taken.column(c) for c in ("query_id", "row", "q", "q_y", "bound")), pa.array(cells[j])],
                    names=["query_id", "row", "q", "q_y", "bound", "cell"])

    away = materialize(bounded.select("query_id", "row", "q", "q_y", "bound", "cell").mapInArrow(
        others, "query_id long, row long, q array<double>, q_y array<double>, bound double, cell int"), "projections-away")
    found = home.drop("rank").unionByName(visit(away))
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
