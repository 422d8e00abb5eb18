"""Saved tree ensembles as tables: relational scoring and importances.

A saved forest or boosted model is a Parquet table of nodes. Members are scored
by joins: each (member, tree) starts at node 0 and moves to the child that its
feature value selects, one join a level. The node table is broadcast when it is
counted small (trees x nodes, whatever the members), else joined by shuffle.
Only continuous splits are known; a categorical one is an error.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_NODES = 200_000


def tree_nodes(spark: SparkSession, pipeline_path: str) -> DataFrame:
    """(tree, weight, node, feature, threshold, low, high, prediction, share, gain, rows) of the
    ensemble that is the last stage of a saved pipeline; ``feature`` is NULL in leaves."""
    stage = f"{pipeline_path.rstrip('/')}/stages/2_*"
    # the metadata table has no column names: number of the tree, its metadata, its weight
    weights = spark.read.parquet(f"{stage}/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")
    node = spark.read.parquet(f"{stage}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    edge = F.when(F.col("split.numCategories") == -1, F.col("split.leftCategoriesOrThreshold")[0]).otherwise(
        F.raise_error(F.lit("a categorical split cannot be scored here")).cast("double"))
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return node.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, edge).alias("threshold"), F.when(inner, F.col("leftChild")).alias("low"),
        F.when(inner, F.col("rightChild")).alias("high"), "prediction",
        F.try_divide(F.get("impurityStats", F.lit(1)), total).alias("share"), "gain", total.alias("rows"),
    ).join(F.broadcast(weights), "tree")    # one row a tree


def reached_leaves(features: DataFrame, nodes: DataFrame, trees: int, depth: int, id_col: str = "member_id") -> DataFrame:
    """(id, tree, weight, node, prediction, share): the leaf of every tree that each row of
    (id, ``x`` array of doubles) reaches."""
    known = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
    at = features.select(id_col, "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        step = known.select("tree", "node", "feature", "threshold", "low", "high")
        child = F.when(F.col("feature").isNull(), F.col("node")).when(
            F.get("x", "feature") <= F.col("threshold"), F.col("low")).otherwise(F.col("high"))
        at = at.join(step, ["tree", "node"]).select(id_col, "x", "tree", child.alias("node"))
    return at.drop("x").join(known.select("tree", "node", "weight", "prediction", "share"), ["tree", "node"])


def relational_scores(spark: SparkSession, pipeline_path: str, model: PipelineModel, rows: DataFrame,
                      id_col: str = "member_id") -> DataFrame:
    """(id, relational_score, trees): the probability of class 1 from the saved node table.

    A forest averages the shares of its leaves; boosting adds weighted leaf values up
    to a margin m, whose probability is 1 / (1 + exp(-2 m)).
    """
    ensemble = model.stages[-1]
    x = rows
    for stage in model.stages[:-1]:
        x = stage.transform(x)
    x = x.select(id_col, vector_to_array("features").alias("x"))
    leaves = reached_leaves(x, tree_nodes(spark, pipeline_path), ensemble.getNumTrees, ensemble.getMaxDepth(), id_col)
    boosted = type(ensemble).__name__.startswith("GBT")
    margin = F.sum(F.col("weight") * F.col("prediction"))
    score = 1 / (1 + F.exp(-2 * margin)) if boosted else F.avg("share")
    return leaves.groupBy(id_col).agg(score.alias("relational_score"), F.count(F.lit(1)).alias("trees"))


def relational_importances(nodes: DataFrame) -> DataFrame:
    """(feature, importance): gain times rows of a feature's splits, each tree scaled to 1
    and the sum over trees scaled to 1. Features without a split are absent."""
    split = nodes.filter(F.col("feature").isNotNull()).groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("rows")).alias("g"))
    trees = split.groupBy("tree").agg(F.sum("g").alias("tree_g"))
    per = split.join(trees, "tree").groupBy("feature").agg(F.sum(F.try_divide("g", "tree_g")).alias("g"))
    total = per.agg(F.sum("g")).first()[0]
    return per.select("feature", (F.col("g") / F.lit(total)).alias("importance"))
