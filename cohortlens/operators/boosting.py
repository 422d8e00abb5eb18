"""Boosted trees with second-order splits, from histograms of gradients.

Spark ML's boosting fits each tree to residuals and samples columns per node.
This learner works on first and second derivatives of the weighted log loss:

* Every feature is cut once at up to ``bins`` quantiles; a row then carries one
  small array of bin numbers, written once under the checkpoint folder.
* A level of a tree is one sum of derivatives by (node, feature, bin). Every
  task adds its rows up in an array before the shuffle, so what it holds and
  sends is bounded by nodes x columns x bins, whatever its rows. Running sums over a feature's bins and a
  maximum per node give the splits; only those (at most 2^depth) are collected.
* Row samples and column samples are per tree, by md5 of seed, tree and id.
* Derivatives are summed as integers (multiples of a power of two), so the
  trees do not depend on how rows are spread over tasks.

Tasks walk the trees that were finished since margins were written last, every
``save_every`` trees. Trees go to the tasks as numbers, not as expressions, so
the plan of every level is the same and is compiled once.
NULL and NaN count as larger than every value. Node tables have the columns of
``trees.tree_nodes``, so ``trees.reached_leaves`` follows them as well.
"""

from __future__ import annotations

import dataclasses
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.session import materialize

NODE_SCHEMA = ("tree int, weight double, node int, feature int, threshold double, bin int, low int, high int, "
               "prediction double, share double, gain double, rows long, gradient double, hessian double")
LEAST_GAIN = 1e-6
_SAMPLE_UNIT = 2 ** 32


# fixed values: rounds, depth, rates, samples and least weight are the database-backed training run's
@dataclasses.dataclass(frozen=True)
class BoostParams:
    """``l2`` penalises leaf values; ``min_child_weight`` bounds a child's second-derivative sum;
    ``base_margin`` is every row's margin before the first tree."""

    rounds: int = 100
    depth: int = 4
    learning_rate: float = 0.1
    row_sample: float = 0.8
    column_sample: float = 0.8
    min_child_weight: float = 3.0
    l2: float = 1.0
    bins: int = 256
    base_margin: float = 0.0
    seed: int = 42
    save_every: int = 5


@dataclasses.dataclass
class BoostedTrees:
    feature_cols: list[str]
    cuts: list[list[float]]
    nodes: list[dict]       # rows of NODE_SCHEMA: at most rounds x 2^(depth + 1)
    params: BoostParams

    def table(self, spark: SparkSession) -> DataFrame:
        names = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(n[c] for c in names) for n in self.nodes], NODE_SCHEMA)

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds ``margin`` and ``score``, the probability of class 1, from raw feature columns."""
        values = [F.col(c).cast("double") for c in self.feature_cols]
        margin = F.lit(self.params.base_margin)
        for tree in _by_tree(self.nodes):
            margin = margin + _walk(tree, 0, lambda n: values[n["feature"]] <= F.lit(n["threshold"]))
        return rows.withColumn("margin", margin).withColumn("score", 1 / (1 + F.exp(-F.col("margin"))))


def sampled(id_col: str, seed: int, tree: int | Column, fraction: float) -> Column:
    """Whether a row is in the tree's sample; equal ids share their fate."""
    number = (tree if isinstance(tree, Column) else F.lit(tree)).cast("string")
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), number, F.col(id_col).cast("string"))), 1, 8)
    return F.col(id_col).isNull() | (F.conv(digits, 16, 10).cast("long") < F.lit(int(fraction * _SAMPLE_UNIT)))


def sampled_columns(n: int, seed: int, tree: int, fraction: float) -> list[int]:
    """The tree's columns, ascending; at least one."""
    order = sorted(range(n), key=lambda j: hashlib.md5(f"{seed}|{tree}|column {j}".encode()).hexdigest())
    return sorted(order[:max(1, int(fraction * n))])


def feature_cuts(rows: DataFrame, feature_cols: list[str], bins: int) -> list[list[float]]:
    """Ascending distinct quantiles of each column's present values, all in one pass: at most ``bins`` - 1
    numbers a column. A column without any value has none and is never split."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    present = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in feature_cols]
    row = rows.agg(*[F.percentile_approx(c, at, 10_000).alias(f"q{j}") for j, c in enumerate(present)]).first()
    return [sorted(set(q or [])) for q in row]


def binned(rows: DataFrame, feature_cols: list[str], cuts: list[list[float]], keep: list[Column]) -> DataFrame:
    """``keep`` and ``bins``: for each feature the number of cuts below the value (all of them if missing)."""
    used = [j for j, c in enumerate(cuts) if c]
    raw = rows.select(*keep, *[F.coalesce(F.col(feature_cols[j]).cast("double"), F.lit(float("nan"))).alias(f"x{j}")
                               for j in used])
    # the bucketizer's buckets are closed below, bins are closed above
    edges = [[-math.inf, *[math.nextafter(c, math.inf) for c in cuts[j]], math.inf] for j in used]
    out = Bucketizer(inputCols=[f"x{j}" for j in used], outputCols=[f"b{j}" for j in used], splitsArray=edges,
                     handleInvalid="keep").transform(raw) if used else raw
    # a missing value has the extra bucket; it belongs to the last one
    array = F.array(*[F.least(F.col(f"b{j}"), F.lit(float(len(cuts[j])))).cast("short") if cuts[j]
                      else F.lit(0).cast("short") for j in range(len(feature_cols))])
    return out.select(*raw.columns[:len(keep)], array.alias("bins"))


def _by_tree(nodes: list[dict]) -> list[dict[int, dict]]:
    out: dict[int, dict[int, dict]] = {}
    for n in nodes:
        out.setdefault(n["tree"], {})[n["node"]] = n
    return [out[t] for t in sorted(out)]


def _walk(tree: dict[int, dict], node: int, goes_low, leaf: str = "prediction") -> Column:
    """The value of the leaf that a row reaches, as one nested condition."""
    n = tree[node]
    if n["feature"] is None:
        return F.lit(n[leaf])
    return F.when(goes_low(n), _walk(tree, n["low"], goes_low, leaf)).otherwise(_walk(tree, n["high"], goes_low, leaf))


class _Tree:
    """A tree as arrays by node number; a leaf has the feature -1."""

    def __init__(self, nodes: list[dict]):
        size = max((n["node"] for n in nodes), default=0) + 1
        self.feature, self.bin, self.low, self.high = (np.full(size, -1, dtype=np.int64) for _ in range(4))
        self.value = np.zeros(size)
        for n in nodes:
            at = n["node"]
            self.value[at] = n["prediction"]
            if n["feature"] is not None:
                self.feature[at], self.bin[at], self.low[at], self.high[at] = n["feature"], n["bin"], n["low"], n["high"]

    def reached(self, bins: np.ndarray) -> np.ndarray:
        """The number of the leaf that each row of bins reaches."""
        at, row = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        while (inner := self.feature[at] >= 0).any():
            low = bins[row, self.feature[at]] <= self.bin[at]
            at = np.where(inner, np.where(low, self.low[at], self.high[at]), at)
        return at


def _bins_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _margins(batch: pa.RecordBatch, bins: np.ndarray, trees: list[_Tree]) -> np.ndarray:
    """The written margins plus the values of the trees since."""
    margin = batch.column("margin").to_numpy(zero_copy_only=False)
    for t in trees:
        margin = margin + t.value[t.reached(bins)]
    return margin


def with_margins(data: DataFrame, trees: list[_Tree]) -> DataFrame:
    """The rows (.., bins, margin) with the values of ``trees`` added to their margin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margin = pa.array(_margins(batch, _bins_of(batch), trees))
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", margin)

    return data.mapInArrow(run, data.schema)


def _unit(rows: int, largest_weight: float) -> float:
    """The power of two by which derivatives are multiplied, so that their sum over all rows fits a long."""
    return 2.0 ** min(40, 61 - math.ceil(math.log2(max(rows * max(largest_weight, 1.0), 2.0))))


def _whole(x: np.ndarray) -> np.ndarray:
    return np.nan_to_num(np.floor(x + 0.5)).astype(np.int64)


def _added(place: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place, exactly: halves of 30 bits fit the doubles in which they are added."""
    high = numbers >> 30
    return (np.bincount(place, high, size).astype(np.int64) << 30) + np.bincount(
        place, numbers - (high << 30), size).astype(np.int64)


def level_histogram(rows: DataFrame, columns: list[int], width: int, unit: float, before: list[_Tree], tree: _Tree,
                    open_nodes: list[int]) -> DataFrame:
    """(node, place, bin, n, g, h): sums of the derivatives of rows (y, w, bins, margin) at the open nodes of ``tree``,
    times ``unit``; ``place`` counts ``columns``, ``before`` are the trees since margins were written."""
    slot = np.full(max(len(tree.feature), max(open_nodes) + 1), -1, dtype=np.int64)
    slot[open_nodes] = np.arange(len(open_nodes))
    size = len(open_nodes) * len(columns) * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, size), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _bins_of(batch)
            at = slot[tree.reached(bins)]
            y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-_margins(batch, bins, before)))
            g, h = _whole(w * (p - y) * unit), _whole(w * p * (1 - p) * unit)
            here = at >= 0
            place = ((at[here, None] * len(columns) + np.arange(len(columns))) * width + bins[here][:, columns]).ravel()
            for total, x in zip(sums, (np.ones_like(g), g, h)):
                total += _added(place, np.repeat(x[here], len(columns)), size)
        found = np.flatnonzero(sums[0])
        node = np.array(open_nodes)[found // (len(columns) * width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int32)) for x in (node, found // width % len(columns), found % width)]
            + [pa.array(total[found]) for total in sums], names=["node", "place", "bin", "n", "g", "h"])

    return rows.mapInArrow(run, "node int, place int, bin int, n long, g long, h long").repartition(
        "node", "place").groupBy("node", "place", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "g", "h")])


def best_splits(histogram: DataFrame, unit: float, params: BoostParams) -> DataFrame:
    """One row a node: its totals and, if any split is allowed, the best (else NULL). Ties go to the smaller
    column and bin."""
    by_feature = Window.partitionBy("node", "place")
    upto = by_feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = histogram.select("node", "place", "bin", *[F.sum(c).over(upto).alias(f"{c}_low") for c in ("n", "g", "h")],
                            *[F.sum(c).over(by_feature).alias(c) for c in ("n", "g", "h")])

    def quality(g: Column, h: Column) -> Column:
        return (g / F.lit(unit)) * (g / F.lit(unit)) / (h / F.lit(unit) + F.lit(params.l2))

    g, h, gl, hl = (F.col(c) for c in ("g", "h", "g_low", "h_low"))
    gain = F.lit(0.5) * (quality(gl, hl) + quality(g - gl, h - hl) - quality(g, h))
    least = F.lit(params.min_child_weight)
    allowed = (F.col("n_low") < F.col("n")) & (hl / F.lit(unit) >= least) & ((h - hl) / F.lit(unit) >= least) & (
        gain > LEAST_GAIN)
    choice = F.when(allowed, F.struct(gain.alias("gain"), (-F.col("place")).alias("place"), (-F.col("bin")).alias("bin"),
                                      "n_low", "g_low", "h_low"))
    return sums.groupBy("node").agg(F.max(choice).alias("best"), *[F.max(c).alias(c) for c in ("n", "g", "h")])


def _grow(rows: DataFrame, tree: int, cuts: list[list[float]], unit: float, params: BoostParams,
          before: list[_Tree]) -> list[dict]:
    """Nodes of one tree over the sampled rows (y, w, bins, margin), one job a level."""
    width = max((len(c) for c in cuts), default=0) + 1
    columns = sampled_columns(len(cuts), params.seed, tree, params.column_sample)

    def node(number: int, n: int, g: int, h: int) -> dict:
        value = -params.learning_rate * (g / unit) / (h / unit + params.l2)
        return dict(tree=tree, weight=1.0, node=number, feature=None, threshold=None, bin=None, low=None, high=None,
                    prediction=value, share=None, gain=None, rows=n, gradient=g / unit, hessian=h / unit)

    nodes: dict[int, dict] = {}
    open_nodes = {0}
    for _ in range(params.depth):
        histogram = level_histogram(rows, columns, width, unit, before, _Tree(list(nodes.values())), sorted(open_nodes))
        found = best_splits(histogram, unit, params).collect()   # at most 2^level rows
        opened = set()
        for r in found:
            mine = nodes.setdefault(r["node"], node(r["node"], r["n"], r["g"], r["h"]))
            best = r["best"]
            if best is None:
                continue
            j, b, low = columns[-best["place"]], -best["bin"], 2 * r["node"] + 1
            mine.update(feature=j, threshold=cuts[j][b], bin=b, low=low, high=low + 1, gain=best["gain"])
            nodes[low] = node(low, best["n_low"], best["g_low"], best["h_low"])
            nodes[low + 1] = node(low + 1, r["n"] - best["n_low"], r["g"] - best["g_low"], r["h"] - best["h_low"])
            opened |= {low, low + 1}
        # a child that cannot be parted into two of the least weight needs no histogram
        open_nodes = {k for k in opened if nodes[k]["rows"] > 1 and nodes[k]["hessian"] >= 2 * params.min_child_weight}
        if not open_nodes:
            break
    if not nodes:   # an empty sample
        nodes[0] = {**node(0, 0, 0, 0), "prediction": 0.0}
    return [nodes[k] for k in sorted(nodes)]


def fit(train: DataFrame, feature_cols: list[str], label: str = K.LABEL_COLUMN, weight: str | None = None,
        id_col: str = "member_id", params: BoostParams = BoostParams()) -> BoostedTrees:
    """Boosted trees over rows with a 0/1 label and optional weights.

    Rows without a label or weight take no part; rows without an id are in every tree's sample. An empty
    table gives trees that are single leaves of value 0. Quantiles are exact up to 10,000 distinct values a
    column, beyond that those of Spark's sketch.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = train.where(F.col(label).isNotNull() & w.isNotNull())
    cuts = feature_cuts(rows, feature_cols, params.bins)
    keep = [F.col(id_col).alias("id"), F.col(label).cast("double").alias("y"), w.alias("w")]
    data = materialize(binned(rows, feature_cols, cuts, keep).withColumn("margin", F.lit(params.base_margin)), "boost-rows")
    n, largest = data.agg(F.count(F.lit(1)), F.max("w")).first()
    unit = _unit(n, largest or 1.0)
    nodes: list[dict] = []
    recent: list[_Tree] = []     # trees whose values are not yet in the written margins
    for tree in range(params.rounds):
        drawn = data.where(sampled("id", params.seed, tree, params.row_sample)).select("y", "w", "bins", "margin")
        grown = _grow(drawn, tree, cuts, unit, params, recent)
        nodes += grown
        recent.append(_Tree(grown))
        if (tree + 1) % params.save_every == 0 and tree + 1 < params.rounds:
            data = materialize(with_margins(data, recent), "boost-rows")
            recent = []
    return BoostedTrees(list(feature_cols), cuts, nodes, params)


def log_loss(scored: DataFrame, label: str = K.LABEL_COLUMN, weight: Column | None = None) -> float:
    """Mean weighted log loss of rows with ``margin``."""
    w = F.lit(1.0) if weight is None else weight
    signed = F.when(F.col(label) == 1, F.col("margin")).otherwise(-F.col("margin"))
    # log(1 + exp(-m)) without overflow
    loss = F.log1p(F.exp(-F.abs(signed))) + F.greatest(-signed, F.lit(0.0))
    return scored.agg(F.sum(w * loss) / F.sum(w)).first()[0]
