"""Evaluation: confusion counts, precision/recall/F1, ROC AUC, reports.

All metrics are aggregates over prediction tables; nothing is gathered
except the final one-row results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import constants as K
from cohortlens.session import materialize


def _div(a, b):
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def confusion_counts(pred: DataFrame, label: str = K.LABEL_COLUMN,
                     prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return pred.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def classification_metrics(pred: DataFrame, label: str = K.LABEL_COLUMN,
                           prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, F1 of class 1 (0 when undefined), unrounded."""
    c = confusion_counts(pred, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision, recall = _div(tp, tp + fp), _div(tp, tp + fn)
    f1 = _div(2 * tp, 2 * tp + fp + fn)
    return c.select(
        "tp", "fp", "fn", "tn",
        _div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score"))


def roc_auc(pred: DataFrame, label: str = K.LABEL_COLUMN, score: str = "score",
            buckets: int = 4096) -> DataFrame:
    """Exact area under the ROC curve with ties counted half (Mann-Whitney).

    AUC = sum over scores of pos(s) * (neg below s + neg(s) / 2) / (P * N).
    Rows are first reduced to one per distinct score (a score shared by a
    third of all rows is one row). The running count of negatives is built
    in two levels: equal-frequency buckets of the distinct scores (bounds
    from one ``percentile_approx`` pass, at most ``buckets - 1`` values,
    applied with ``Bucketizer``) get cumulated offsets from a table of at
    most ``buckets`` rows, and the running sum inside a bucket is a window
    over that bucket's share of distinct scores only, however the scores
    crowd. Bucket bounds only organise the sum, so the result stays exact.
    The per-score table feeds two passes, so it is written once.
    One class only gives 0.0, as the reference's fallback does.
    """
    from pyspark.ml.feature import Bucketizer

    y = F.col(label)
    per_score = materialize(pred.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")), "auc-scores")
    probs = [i / buckets for i in range(1, buckets)]
    bounds = per_score.agg(F.percentile_approx("s", probs, 10 * buckets).alias("q")).first()["q"]
    splits = [float("-inf")] + sorted({float(b) for b in (bounds or [])}) + [float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="s", outputCol="b").transform(per_score)
    per_bucket = bucketed.groupBy("b").agg(F.sum("neg").alias("bneg"))
    offsets = per_bucket.select(
        "b", (F.sum("bneg").over(Window.orderBy("b")) - F.col("bneg")).alias("off"))
    inside = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (bucketed.join(F.broadcast(offsets), "b")
              .withColumn("below", F.col("off") + F.coalesce(F.sum("neg").over(inside), F.lit(0))))
    total = ranked.agg(
        F.sum(F.col("pos").cast("double") * (F.col("below") + F.col("neg") / 2.0)).alias("area"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0),
                 F.col("area") / F.col("P").cast("double") / F.col("N").cast("double")).otherwise(F.lit(0.0))
    return total.select(auc.alias("roc_auc"))


def confusion_matrix(pred: DataFrame, label: str = K.LABEL_COLUMN,
                     prediction: str = "prediction") -> DataFrame:
    """actual x predicted counts with all four cells present."""
    c = confusion_counts(pred, label, prediction)
    return c.select(F.inline(F.array(
        *[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(cell).alias("n"))
          for a, p, cell in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])))


def classification_report(pred: DataFrame, label: str = K.LABEL_COLUMN,
                          prediction: str = "prediction",
                          names: tuple[str, str] = ("Active", "Churned")) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion_counts(pred, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    # class 0 treats "negative" as the positive class
    p1, r1, f1 = _div(tp, tp + fp), _div(tp, tp + fn), _div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _div(tn, tn + fn), _div(tn, tn + fp), _div(2 * tn, 2 * tn + fn + fp)
    s0, s1 = tn + fp, tp + fn
    acc = _div(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_name"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("long").alias("support"))
    rows = F.array(
        row(names[0], p0, r0, f0, s0),
        row(names[1], p1, r1, f1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n),
            _div(f0 * s0 + f1 * s1, n), n))
    out = c.select(F.inline(rows))
    return out.withColumns({x: F.round(x, 4) for x in ("precision", "recall", "f1_score")})


def fold_f1(pred: DataFrame, label: str = K.LABEL_COLUMN, prediction: str = "prediction",
            fold: str = "fold") -> DataFrame:
    """F1 of class 1 per fold, then mean and population std across folds."""
    y, p = F.col(label), F.col(prediction)
    per = pred.groupBy(fold).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"))
    per = per.withColumn("f1", _div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
    return per.agg(F.avg("f1").alias("cv_f1_mean"), F.stddev_pop("f1").alias("cv_f1_std"))


METRIC_COLUMNS = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "cv_f1_mean", "cv_f1_std")


def rounded(metrics: DataFrame) -> DataFrame:
    """Metrics as shown and saved: four places. Compare models before this."""
    return metrics.withColumns({c: F.round(c, 4) for c in METRIC_COLUMNS if c in metrics.columns})


def metrics_table(spark: SparkSession, rows: dict[str, dict[str, float]]) -> DataFrame:
    """One row per model from already computed one-row metric results."""
    schema = T.StructType([T.StructField("model", T.StringType(), False),
                           T.StructField("model_order", T.IntegerType(), False)]
                          + [T.StructField(c, T.DoubleType()) for c in METRIC_COLUMNS])
    data = [(name, K.MODEL_ORDER.index(name) if name in K.MODEL_ORDER else len(K.MODEL_ORDER),
             *[None if m.get(c) is None else float(m[c]) for c in METRIC_COLUMNS])
            for name, m in rows.items()]
    return spark.createDataFrame(data, schema)


def compare(spark: SparkSession, held_out: DataFrame, out_of_fold: DataFrame | None, names) -> DataFrame:
    """``metrics_table`` of the models in (model, label, prediction, score) tables: held-out
    metrics of each, and F1 over the folds of the out-of-fold table (with ``fold``)."""
    rows = {}
    for name in names:
        mine = held_out.where(F.col("model") == name)
        rows[name] = classification_metrics(mine).first().asDict() | roc_auc(mine).first().asDict()
        if out_of_fold is not None:
            rows[name] |= fold_f1(out_of_fold.where(F.col("model") == name)).first().asDict()
    return metrics_table(spark, rows)


def part_counts(held_out: DataFrame, out_of_fold: DataFrame) -> DataFrame:
    """Confusion counts of every model on the held-out rows (part ``held out``) and on each fold, and
    whether its F1 is higher than that of calling every member churned."""
    y, p = F.col(K.LABEL_COLUMN), F.col("prediction")
    parts = held_out.withColumn("part", F.lit("held out")).unionByName(
        out_of_fold.withColumn("part", F.concat(F.lit("fold "), F.col("fold"))).drop("fold"))
    counts = parts.groupBy("model", "part").agg(
        F.count(F.lit(1)).alias("members"), F.count_distinct("member_id").alias("distinct_members"),
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    f1 = _div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    positives, negatives = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    return counts.withColumn("beats_constant", f1 > _div(2 * positives, 2 * positives + negatives))


def best_model(metrics: DataFrame) -> DataFrame:
    """Highest unrounded F1; a tie goes to the earliest model in the comparison order."""
    return metrics.orderBy(F.col("f1_score").desc(), F.col("model_order").asc()).limit(1)


def mark_best(metrics: DataFrame) -> DataFrame:
    best = best_model(metrics).select(F.col("model").alias("_best"))
    return (metrics.join(F.broadcast(best), F.col("model") == F.col("_best"), "left")
            .withColumn("is_best", F.col("_best").isNotNull()).drop("_best"))
