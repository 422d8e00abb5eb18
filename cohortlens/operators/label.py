"""Churn label from inactivity, the additive rule score, and label summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import null_to_sentinel, sentinel_to_null


def _present(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]


def recency_sentinel_to_null(df: DataFrame) -> DataFrame:
    """9999 ("never") -> NULL in the recency columns."""
    return df.withColumns({c: sentinel_to_null(F.col(c)) for c in _present(df, K.RECENCY_COLUMNS)})


def recency_null_to_sentinel(df: DataFrame) -> DataFrame:
    """NULL -> 9999 in the recency columns (a NULL on input also comes back as 9999)."""
    return df.withColumns({c: null_to_sentinel(F.col(c)) for c in _present(df, K.RECENCY_COLUMNS)})


def min_recency_expr(df: DataFrame) -> Column:
    """Row-wise minimum of the recencies; NULLs are skipped, all NULL gives NULL."""
    cols = [sentinel_to_null(F.col(c)) for c in _present(df, K.RECENCY_COLUMNS)]
    return F.least(*cols) if len(cols) > 1 else cols[0]


def total_activity_expr(df: DataFrame) -> Column:
    """Sum of the channel totals that exist; a NULL total makes the sum NULL."""
    cols = [F.col(c) for c in _present(df, K.ACTIVITY_COLUMNS)]
    return reduce(lambda a, b: a + b, cols)


def churn_label(df: DataFrame, threshold_days: int = K.DEFAULT_CHURN_THRESHOLD_DAYS) -> DataFrame:
    """Adds ``min_days_since_activity``, ``total_activity_count`` and ``is_churned``.

    Churned when there is no activity at all, no recency in any channel, or
    the most recent activity is strictly older than ``threshold_days``.
    Comparisons against NULL count as false, as NaN comparisons do in pandas.
    Recency columns leave with NULL replaced by 9999; the helper keeps NULL.
    """
    labelled = df.withColumns({
        "min_days_since_activity": min_recency_expr(df),
        "total_activity_count": total_activity_expr(df),
    })
    m, total = F.col("min_days_since_activity"), F.col("total_activity_count")
    churned = (F.coalesce(total == 0, F.lit(False)) | m.isNull()
               | F.coalesce(m > F.lit(threshold_days), F.lit(False)))
    return recency_null_to_sentinel(labelled.withColumn(K.LABEL_COLUMN, churned.cast("int")))


def label_distribution(labelled: DataFrame) -> DataFrame:
    """Members per label and the churn rate, as one row."""
    y = F.col(K.LABEL_COLUMN)
    return labelled.agg(
        F.count(F.lit(1)).alias("n_members"),
        F.count_if(y == 1).alias("n_churned"),
        F.count_if(y == 0).alias("n_active"),
        F.avg(y.cast("double")).alias("churn_rate"),
    )


# --- fixed values: additive rule score, in integer hundredths -------------------
#   meals < 15: 25, else meals < 40: 10; weights < 5: 10; exercises < 5: 10;
#   meal recency > 14: 20, else > 7: 10; weight recency > 14: 10;
#   exercise recency > 14: 10; compliance < 0.3: 10; completion < 0.2: 5;
#   clipped to [0, 100]; churned when the score is at least 40.
RULE_CHURNED_AT = 40


def rule_points_expr() -> Column:
    meals, weights = F.col("total_meal_logs"), F.col("total_weight_logs")
    exercises = F.col("total_exercise_logs")
    meal_days, weight_days = F.col("days_since_last_meal"), F.col("days_since_last_weight")
    exercise_days = F.col("days_since_last_exercise")
    parts = [
        F.when(meals < 15, 25).when(meals < 40, 10).otherwise(0),
        F.when(weights < 5, 10).otherwise(0),
        F.when(exercises < 5, 10).otherwise(0),
        F.when(meal_days > 14, 20).when(meal_days > 7, 10).otherwise(0),
        F.when(weight_days > 14, 10).otherwise(0),
        F.when(exercise_days > 14, 10).otherwise(0),
        F.when(F.col("meal_compliance_rate") < 0.3, 10).otherwise(0),
        F.when(F.col("collection_completion_rate") < 0.2, 5).otherwise(0),
    ]
    total = reduce(lambda a, b: a + b, parts)
    return F.greatest(F.lit(0), F.least(F.lit(100), total))


def rule_churn_score(df: DataFrame) -> DataFrame:
    """Deterministic rule score in [0, 1] and its 0/1 decision (score >= 0.40).

    Points are summed as integers, so the threshold test is exact.
    """
    points = rule_points_expr()
    return df.withColumns({
        "rule_churn_score": points / F.lit(100.0),
        "rule_churned": (points >= RULE_CHURNED_AT).cast("int"),
    })


def group_profile(labelled: DataFrame) -> DataFrame:
    """Group sizes and mean activity profile of active vs churned members."""
    return labelled.groupBy(K.LABEL_COLUMN).agg(
        F.count(F.lit(1)).alias("n_members"),
        F.avg("enrollment_age_days").alias("avg_enrollment_days"),
        F.avg("total_meal_logs").alias("avg_meal_logs"),
        F.avg("total_weight_logs").alias("avg_weight_logs"),
        F.avg("total_exercise_logs").alias("avg_exercise_logs"),
        F.avg("meal_compliance_rate").alias("avg_compliance"),
        F.avg("days_since_last_meal").alias("avg_days_since_meal"),
    )
