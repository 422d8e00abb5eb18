"""Exact quantiles (linear interpolation) without gathering a column anywhere.

Spark's exact ``percentile`` merges every distinct value of a column into one
aggregation buffer in one task; on a wide member table that buffer grows with
the data. Here every wanted order statistic is found in three passes, for all
columns together:

1. count, min and max of every column;
2. one bounded sketch a column (``percentile_approx``) proposes a bracket
   around each of its wanted ranks; overlapping brackets are united;
3. exact counts: every value becomes the number of its bracket, or of the gap
   between two, and only values inside a bracket are kept apart. Running
   counts over these few rows name the value of each rank, and prove that it
   lay in its bracket.

The sketch's rank error is at most ``1 / ACCURACY``, so a bracket holds a few
``1 / ACCURACY`` of a column's values. Counting is pre-aggregated before its
shuffle, and a value shared by a third of all rows is one row. The driver reads
a few numbers per wanted rank, whatever the data. Results equal pandas
``quantile`` / DuckDB ``quantile_cont``: ``v[k] + (v[k+1] - v[k]) * frac`` at
position ``p * (n - 1)``. NULL and NaN are skipped; a column without values
gives ``None``.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 2_000    # of the sketch; its size is proportional to it


@dataclasses.dataclass
class _Rank:
    """One wanted order statistic: the value of rank ``rank`` among the ``n`` of column number ``column``."""

    column: int
    rank: int
    low: float
    high: float
    n: int
    value: float | None = None


def missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    floating = dict(df.dtypes)[c] in ("double", "float")
    return F.col(c).isNull() | F.isnan(c) if floating else F.col(c).isNull()


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(c, v): the number of the column and the value, for every value; c = -1 once for every row.

    One row a value keeps the plans small and lets each column be merged in
    a task of its own; aggregates combine before the shuffle.
    """
    types = dict(df.dtypes)
    cells = [F.struct(F.lit(-1).alias("c"), F.lit(0.0).alias("v"))]
    cells += [F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)]
    v = F.col("x.v")
    if any(types[c] in ("double", "float") for c in cols):
        v = F.when(~F.isnan(v), v)
    return df.select(F.explode(F.array(*cells)).alias("x")).select("x.c", v.alias("v")).filter("v IS NOT NULL")


def column_stats(df: DataFrame, cols: list[str]) -> dict[str, tuple]:
    """(count of values, min, max) of each column, and the row count as ``__rows__``, in one pass."""
    found = {r["c"]: (r["n"], r["low"], r["high"]) for r in _long(df, cols).groupBy("c").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    out: dict[str, tuple] = {c: found.get(i, (0, None, None)) for i, c in enumerate(cols)}
    return {**out, "__rows__": found.get(-1, (0,))[0]}


def _brackets(data: DataFrame, active: list[_Rank]) -> dict[int, list[tuple[float, float]]]:
    """Disjoint ascending brackets of each column around its wanted ranks, from one sketch a column."""
    room = 2 / ACCURACY
    around = {(r.rank, r.n): (max(0.0, r.rank / r.n - room), min(1.0, (r.rank + 1) / r.n + room)) for r in active}
    fractions = sorted({f for pair in around.values() for f in pair})
    place = {f: i for i, f in enumerate(fractions)}
    sketches = {r["c"]: r["q"] for r in data.groupBy("c").agg(
        F.percentile_approx("v", fractions, ACCURACY).alias("q")).collect()}
    proposed: dict[int, list[tuple[float, float]]] = {}
    for r in active:
        low, high = (sketches[r.column][place[f]] for f in around[r.rank, r.n])
        proposed.setdefault(r.column, []).append((r.low if r.rank / r.n <= room else low,
                                                  r.high if (r.rank + 1) / r.n >= 1 - room else high))
    out = {}
    for c, pairs in proposed.items():
        united: list[tuple[float, float]] = []
        for low, high in sorted(pairs):
            if united and low <= united[-1][1]:
                low, high = united[-1][0], max(high, united.pop()[1])
            united.append((low, high))
        out[c] = united
    return out


def _narrow(data: DataFrame, active: list[_Rank]) -> None:
    """Find all wanted values: bracket them, then count exactly."""
    brackets = _brackets(data, active)
    spark = data.sparkSession
    edges = spark.createDataFrame([(c, [x[0] for x in found], [x[1] for x in found]) for c, found in brackets.items()],
                                  "c int, lows array<double>, highs array<double>")
    v = F.col("v")
    before = F.size(F.filter("highs", lambda high: high < v))       # brackets that end before the value
    inside = (F.col("before") < F.size("highs")) & (v >= F.get("lows", F.col("before")))
    counts = (data.join(F.broadcast(edges), "c")                    # one row a column
              .withColumn("before", before).withColumn("inside", inside)
              .groupBy("c", "before", "inside", F.when(F.col("inside"), v).alias("v")).agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("c").orderBy("before", "inside", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = spark.createDataFrame([(r.column, r.rank) for r in active], "c int, rank long")
    found = counts.withColumn("upto", F.sum("n").over(upto)).join(F.broadcast(wanted), "c").filter(   # a few ranks a column
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    values = {(x["c"], x["rank"]): x["v"] for x in found.select("c", "rank", "v").collect()}
    for r in active:
        r.value = values.get((r.column, r.rank))
        if r.value is None:
            raise RuntimeError(f"rank {r.rank} of column {r.column} left its bracket: the data changed between passes")


def order_statistics(df: DataFrame, wanted: dict[str, set[int]], stats: dict[str, tuple]) -> dict[tuple[str, int], float]:
    """The values of the wanted ranks (from 0) among the values of each column."""
    ranks: dict[tuple[str, int], _Rank] = {}
    for c, positions in wanted.items():
        n, low, high = stats[c]
        for k in positions:
            known = low if low == high or k == 0 else high if k == n - 1 else None
            ranks[c, k] = _Rank(0, k, low, high, n, known)
    open_ = {c: None for (c, _), r in ranks.items() if r.value is None}
    cols = list(open_)
    active = [r for (c, _), r in ranks.items() if r.value is None]
    for (c, _), r in ranks.items():
        r.column = cols.index(c) if c in open_ else -1
    if active:
        _narrow(_long(df, cols).filter("c >= 0"), active)
    return {key: r.value for key, r in ranks.items()}


def position(p: float, n: int) -> tuple[int, int, float]:
    """(rank below, rank above, share of the way) of the ``p`` quantile of ``n`` values."""
    at = p * (n - 1)
    k = int(math.floor(at))
    return k, min(k + 1, n - 1) if at > k else k, at - k


def between(low: float, high: float, share: float) -> float:
    return low + (high - low) * share if share else low


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    stats: dict[str, tuple] | None = None) -> dict[str, list[float | None]]:
    """``probs`` quantiles of each column; ``stats`` (from ``column_stats``) saves the first pass."""
    if not cols:
        return {}
    if stats is None or any(c not in stats for c in cols):
        stats = column_stats(df, cols)
    places = {c: [position(p, stats[c][0]) for p in probs] if stats[c][0] else [] for c in cols}
    values = order_statistics(df, {c: {k for below, above, _ in at for k in (below, above)} for c, at in places.items()}, stats)
    return {c: [between(values[c, below], values[c, above], share) for below, above, share in at] or [None] * len(probs)
            for c, at in places.items()}
