"""Stratified hold-out split, stratified folds, class weights, standard scaling.

The split ranks members inside their label by ``md5(seed|id)``. A plain
``row_number`` over ``partitionBy(label)`` would put half the table in one
task; instead the rank is built in two levels: the first three hex digits of
the hash form 4096 buckets per label, a tiny (label, bucket) count table is
cumulated into offsets and broadcast (at most 2 x 4096 rows, a proven
bound), and ``row_number`` runs only inside each (label, bucket). Buckets
follow hash order, so offset + row number equals the plain rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens import constants as K

HASH_PREFIX = 3  # hex digits per bucket: 16**3 buckets per label


def _hash(key: str, seed: int):
    return F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col(key).cast("string")))


def stratified_rank(df: DataFrame, label: str = K.LABEL_COLUMN, key: str = "member_id",
                    seed: int = 42) -> DataFrame:
    """Adds ``rank_in_label`` (1-based, hash order) and ``n_label``."""
    h = _hash(key, seed)
    keyed = df.withColumns({"_h": h, "_b": F.substring(h, 1, HASH_PREFIX)})
    counts = keyed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    by_label = Window.partitionBy(label)
    offsets = counts.select(
        label, "_b",
        (F.sum("_n").over(by_label.orderBy("_b")) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(by_label).alias("n_label"))
    within = Window.partitionBy(label, "_b").orderBy("_h", key)
    ranked = keyed.join(F.broadcast(offsets), [label, "_b"])
    return (ranked.withColumn("rank_in_label", F.col("_offset") + F.row_number().over(within))
            .drop("_h", "_b", "_offset"))


def stratified_split(df: DataFrame, test_fraction: float = 0.2, label: str = K.LABEL_COLUMN,
                     key: str = "member_id", seed: int = 42) -> DataFrame:
    """Adds ``is_test``: the first round(fraction * n_label) members of each
    label in hash order are held out, so the label ratio is kept."""
    ranked = stratified_rank(df, label, key, seed)
    n_test = F.round(F.lit(test_fraction) * F.col("n_label"))
    return ranked.withColumn("is_test", F.col("rank_in_label") <= n_test)


def fold_count(train: DataFrame, label: str = K.LABEL_COLUMN, max_folds: int = 5) -> int:
    """k = min(max_folds, size of the smaller class); at least 2."""
    row = train.agg(F.count_if(F.col(label) == 1).alias("p"),
                    F.count_if(F.col(label) == 0).alias("n")).first()
    k = min(max_folds, row["p"], row["n"])
    if k < 2:
        raise ValueError("stratified folds need at least 2 members in each class")
    return k


def stratified_folds(split: DataFrame, k: int) -> DataFrame:
    """Training rows of a split with ``fold`` in 0..k-1, stratified by label."""
    return (split.where(~F.col("is_test"))
            .withColumn("fold", F.pmod(F.col("rank_in_label") - 1, F.lit(k)).cast("int")))


def class_weights(df: DataFrame, label: str = K.LABEL_COLUMN) -> DataFrame:
    """``w_balanced`` = n / (2 n_class); ``w_boost`` = n_neg / max(n_pos, 1) for
    positives, 1 for negatives. The per-label count table has two rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    everyone = Window.partitionBy()
    stats = counts.select(
        label, "_nc",
        F.sum("_nc").over(everyone).alias("_n"),
        F.sum(F.when(F.col(label) == 1, F.col("_nc")).otherwise(0)).over(everyone).alias("_pos"),
        F.sum(F.when(F.col(label) == 0, F.col("_nc")).otherwise(0)).over(everyone).alias("_neg"))
    joined = df.join(F.broadcast(stats), label)
    return joined.withColumns({
        "w_balanced": F.col("_n") / (F.lit(2.0) * F.col("_nc")),
        "w_boost": F.when(F.col(label) == 1,
                          F.col("_neg") / F.greatest(F.col("_pos"), F.lit(1)).cast("double"))
                    .otherwise(F.lit(1.0)),
    }).drop("_nc", "_n", "_pos", "_neg")


def fit_standard_scale(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column from the training rows (one pass)."""
    row = train.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"),
                                                F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def apply_standard_scale(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std; a zero-variance column is divided by 1."""
    out = {}
    for c, (mean, std) in stats.items():
        mean = 0.0 if mean is None else float(mean)
        scale = 1.0 if not std else float(std)
        out[c] = (F.col(c) - F.lit(mean)) / F.lit(scale)
    return df.withColumns(out)
