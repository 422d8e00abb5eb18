"""Connected components by alternating large-star and small-star rounds.

Each round is two joins and two grouped minima over the links, written to the
shared folder; links stay distributed. A node with a third of all links is
pre-aggregated by the grouped minimum, and its join side is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialize

_WIDTH = 200_000  # links a file of the written table holds


def _write(links: DataFrame, known: int | None) -> DataFrame:
    """Write a round's links; few links go to few files."""
    if known is not None:
        links = links.coalesce(max(4, known // _WIDTH))
    return materialize(links, "component-links")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: join larger neighbours to the smallest neighbour (or self);
    small star: join self and smaller neighbours to the smallest one."""
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(
            F.col("u").alias("k"), F.least("u", "low").alias("low"))
        out = both.filter(F.col("v") > F.col("u")).join(low, F.col("u") == F.col("k")).select(
            F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "k")
        moved = down.join(low, F.col("u") == F.col("k")).filter(F.col("v") != F.col("low")).select(
            F.col("v").alias("u"), F.col("low").alias("v"))
        out = moved.union(low.select(F.col("k").alias("u"), F.col("low").alias("v")))
    return out.filter("u != v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link; root is the component's smallest node."""
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = _write(links, None)
    state = None
    while True:
        now = links.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == state or now["n"] == 0:
            root = F.col("v").alias("root")
            return links.select(F.col("u").alias("node"), root).union(
                links.select(F.col("v").alias("node"), root).distinct())
        state = now
        links = _write(_star(_star(links, True), False), now["n"])
