import math

import pytest
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators import engineer, label

COLS = ("member_id long, total_meal_logs long, total_weight_logs long, total_exercise_logs long, "
        "total_collection_items long, days_since_last_meal int, days_since_last_weight int, "
        "days_since_last_exercise int, days_since_last_collection int")


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_threshold_edges_and_never_active(spark):
    df = frame(spark, [(1, 1, 1, 1, 1, 14, 15, 20, 20), (2, 1, 1, 1, 1, 15, 15, 20, 20),
                       (3, 0, 0, 0, 0, 9999, 9999, 9999, 9999), (4, 5, 0, 0, 0, 9999, 9999, 9999, 9999)])
    out = {r.member_id: r for r in label.churn_label(df, 14).collect()}
    assert out[1].is_churned == 0 and out[1].min_days_since_activity == 14
    assert out[2].is_churned == 1
    assert out[3].is_churned == 1 and out[3].min_days_since_activity is None
    assert out[3].days_since_last_meal == 9999
    assert out[4].is_churned == 1


def test_null_total_and_null_recency(spark):
    df = frame(spark, [(1, None, 1, 1, 1, 3, 20, 20, 20), (2, 1, 1, 1, 1, None, 2, 2, 2)])
    out = {r.member_id: r for r in label.churn_label(df, 14).collect()}
    assert out[1].is_churned == 0 and out[1].total_activity_count is None
    assert out[2].is_churned == 0 and out[2].days_since_last_meal == 9999


def test_rule_score_points(spark):
    df = spark.createDataFrame(
        [(1, 10, 0, 0, 20, 20, 20, 0.1, 0.1), (2, 50, 9, 9, 0, 0, 0, 0.9, 0.9),
         (3, 20, 9, 9, 8, 0, 0, 0.5, 0.9)],
        "member_id long, total_meal_logs long, total_weight_logs long, total_exercise_logs long, "
        "days_since_last_meal int, days_since_last_weight int, days_since_last_exercise int, "
        "meal_compliance_rate double, collection_completion_rate double")
    out = {r.member_id: r for r in label.rule_churn_score(df).collect()}
    assert out[1].rule_churn_score == 1.0 and out[1].rule_churned == 1
    assert out[2].rule_churn_score == 0.0 and out[2].rule_churned == 0
    assert out[3].rule_churn_score == 0.2 and out[3].rule_churned == 0


def test_decay_rates_and_engagement(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, 0, 0, 9999, None, 0, 10, 0, 5, 0, 1, 1, 0)],
        "member_id long, total_meal_logs long, total_weight_logs long, total_exercise_logs long, "
        "total_collection_items long, days_since_last_meal int, days_since_last_weight int, "
        "days_since_last_exercise int, days_since_last_collection int, enrollment_age_days int, "
        "distinct_meal_days int, distinct_weight_days int, meals_last_7_days int, has_doctor int, "
        "has_nutritionist int")
    df = df.withColumn("has_fitness_coach", F.lit(1))
    row = engineer.engineer_features(df).first()
    assert row.meal_recency_score == pytest.approx(math.exp(-18.25))
    assert row.weight_recency_score is None
    assert row.exercise_recency_score == 1.0
    assert row.meal_logging_rate == 0.0 and row.weight_logging_rate == 0.0
    assert row.engagement_score == 0.0
    assert row.has_recent_meals == 1 and row.provider_count == 2
    maxima = engineer.fit_channel_maxima(df)
    assert all(v == 1 for v in maxima.values())


def test_saved_maxima_are_used_for_serving(spark):
    df = frame(spark, [(1, 10, 0, 0, 0, 1, 1, 1, 1)])
    served = engineer.engagement_score(df, {c: 20.0 for c in K.ACTIVITY_COLUMNS}).first()
    batch = engineer.engagement_score(df).first()
    assert served.engagement_score == pytest.approx(0.15)
    assert batch.engagement_score == pytest.approx(0.3)
