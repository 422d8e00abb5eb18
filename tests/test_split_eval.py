import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.operators import evaluate, split


def labelled(spark, n=2000, rate=0.3):
    rng = np.random.default_rng(7)
    y = (rng.random(n) < rate).astype(int)
    return spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "member_id long, is_churned int")


def test_split_is_complete_disjoint_and_stratified(spark):
    df = labelled(spark)
    s = split.stratified_split(df, 0.2)
    assert s.count() == 2000
    for r in s.groupBy("is_churned").agg(F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n")).collect():
        assert r.t == round(0.2 * r.n)
    plain = df.withColumn("h", F.md5(F.concat(F.lit("42|"), F.col("member_id").cast("string")))) \
        .withColumn("r", F.row_number().over(Window.partitionBy("is_churned").orderBy("h", "member_id")))
    joined = s.join(plain, ["member_id", "is_churned"])
    assert joined.where("r != rank_in_label").count() == 0


def test_folds_partition_train(spark):
    s = split.stratified_split(labelled(spark), 0.2)
    k = split.fold_count(s.where(~F.col("is_test")))
    folds = split.stratified_folds(s, k)
    assert k == 5 and folds.count() == s.where(~F.col("is_test")).count()
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2


def test_class_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 2 else 0) for i in range(8)], "member_id long, is_churned int")
    w = {r.member_id: r for r in split.class_weights(df).collect()}
    assert w[0].w_balanced == 2.0 and w[5].w_balanced == pytest.approx(8 / 12)
    assert w[0].w_boost == 3.0 and w[5].w_boost == 1.0


def test_no_predicted_positives_and_auc_ties(spark):
    df = spark.createDataFrame([(1, 0, 0.5), (0, 0, 0.5)], "is_churned int, prediction int, score double")
    m = evaluate.classification_metrics(df).first()
    assert m.precision == 0.0 and m.f1_score == 0.0 and m.accuracy == 0.5
    assert evaluate.roc_auc(df).first().roc_auc == 0.5
    one_class = spark.createDataFrame([(1, 1, 0.5)], "is_churned int, prediction int, score double")
    assert evaluate.roc_auc(one_class).first().roc_auc == 0.0


def test_auc_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.3 + y * 0.2, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "is_churned int, score double")
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert evaluate.roc_auc(df, buckets=16).first().roc_auc == pytest.approx(brute)


def test_best_model_tie_goes_first(spark):
    rows = {name: {"f1_score": 0.9677} for name in ("Random Forest", "Logistic Regression")}
    m = evaluate.metrics_table(spark, rows)
    assert evaluate.best_model(m).first().model == "Logistic Regression"


def test_confusion_matrix_has_four_cells(spark):
    df = spark.createDataFrame([(1, 1)], "is_churned int, prediction int")
    cells = {(r.actual, r.predicted): r.n for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_auc_exact_when_scores_crowd_near_zero(spark):
    rng = np.random.default_rng(9)
    n = 3000
    y = rng.integers(0, 2, n)
    s = np.where(rng.random(n) < 0.34, rng.random(n) * 1e-6, rng.random(n))  # a third crowd at ~0
    s = s + y * 0.05
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "is_churned int, score double")
    order = np.argsort(s, kind="mergesort")
    ranks = np.empty(n)
    ranks[order] = np.arange(1, n + 1)
    pos = y == 1
    brute = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert evaluate.roc_auc(df, buckets=32).first().roc_auc == pytest.approx(brute)


def test_near_tie_is_decided_on_unrounded_f1(spark):
    rows = {"Logistic Regression": {"f1_score": 0.97001}, "Random Forest": {"f1_score": 0.97004}}
    m = evaluate.mark_best(evaluate.metrics_table(spark, rows))
    assert m.where("is_best").first().model == "Random Forest"
    assert {r.f1_score for r in evaluate.rounded(m).collect()} == {0.97}
