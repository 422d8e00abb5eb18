"""Fixed values of the member-engagement data model.

Everything in this module is a fixed value: column names, their order,
thresholds and score weights must equal the published feature contract so
that saved models and downstream reports keep working.
"""

from __future__ import annotations

# --- fixed values: model input columns, in model order (51 names) -----------
FEATURE_COLUMNS: tuple[str, ...] = (
    "gender_encoded",
    "age_years",
    "height_cm",
    "initial_weight_kg",
    "has_medical_conditions",
    "has_allergies",
    "enrollment_age_days",
    "is_enrolled_active",
    "has_doctor",
    "has_nutritionist",
    "has_fitness_coach",
    "total_meal_logs",
    "distinct_meal_days",
    "avg_calories_per_meal",
    "avg_protein_g",
    "avg_carbs_g",
    "avg_fat_g",
    "distinct_meal_types",
    "meal_compliance_rate",
    "days_since_last_meal",
    "meals_last_7_days",
    "meals_last_14_days",
    "total_weight_logs",
    "distinct_weight_days",
    "weight_range_kg",
    "avg_bmi",
    "days_since_last_weight",
    "weight_change_kg",
    "total_exercise_logs",
    "distinct_exercise_days",
    "total_exercise_minutes",
    "avg_exercise_minutes",
    "total_calories_burned",
    "total_steps",
    "days_since_last_exercise",
    "distinct_exercise_types",
    "total_collection_items",
    "completed_items",
    "collection_completion_rate",
    "avg_progress_percent",
    "unlocked_items",
    "days_since_last_collection",
    "engagement_score",
    "meal_recency_score",
    "weight_recency_score",
    "exercise_recency_score",
    "collection_recency_score",
    "meal_logging_rate",
    "weight_logging_rate",
    "has_recent_meals",
    "provider_count",
)

# The first 42 names are produced by activity aggregation, the last 9 by
# feature engineering.
BASE_FEATURE_COLUMNS: tuple[str, ...] = FEATURE_COLUMNS[:42]
ENGINEERED_COLUMNS: tuple[str, ...] = FEATURE_COLUMNS[42:]

# --- fixed values: recency / activity channels ------------------------------
RECENCY_COLUMNS: tuple[str, ...] = (
    "days_since_last_meal",
    "days_since_last_weight",
    "days_since_last_exercise",
    "days_since_last_collection",
)
# the score made from each recency column, and the rate from each day count
RECENCY_SCORES: dict[str, str] = {
    "days_since_last_meal": "meal_recency_score",
    "days_since_last_weight": "weight_recency_score",
    "days_since_last_exercise": "exercise_recency_score",
    "days_since_last_collection": "collection_recency_score",
}
LOGGING_RATES: dict[str, str] = {
    "distinct_meal_days": "meal_logging_rate",
    "distinct_weight_days": "weight_logging_rate",
}
ACTIVITY_COLUMNS: tuple[str, ...] = (
    "total_meal_logs",
    "total_weight_logs",
    "total_exercise_logs",
    "total_collection_items",
)
PROVIDER_COLUMNS: tuple[str, ...] = ("has_doctor", "has_nutritionist", "has_fitness_coach")

# "never logged" marker used in recency columns at the table edges
RECENCY_SENTINEL = 9999

# default inactivity threshold in days (strictly greater means churned)
DEFAULT_CHURN_THRESHOLD_DAYS = 14

# engagement score weights per activity channel, same order as ACTIVITY_COLUMNS
ENGAGEMENT_WEIGHTS: tuple[float, ...] = (0.3, 0.2, 0.2, 0.3)

# recency decay: exp(-rate * min(days, cap))
RECENCY_DECAY_RATE = 0.05
RECENCY_DECAY_CAP_DAYS = 365

# risk bands on the unrounded class-1 probability
RISK_LOW_BELOW = 0.3
RISK_MEDIUM_BELOW = 0.6
RISK_LABELS: tuple[str, ...] = ("Low", "Medium", "High")

# helper columns added by labelling, never model inputs
LABEL_COLUMN = "is_churned"
HELPER_COLUMNS: tuple[str, ...] = ("min_days_since_activity", "total_activity_count")

# name fragments that route a column to zero-imputation instead of the median
ZERO_IMPUTE_NAME_PARTS: tuple[str, ...] = ("count", "total", "days")
# name fragments that exempt a column from quantile clipping
NO_CLIP_NAME_PARTS: tuple[str, ...] = ("encoded", "flag")
CLIP_QUANTILES: tuple[float, float] = (0.01, 0.99)

# the nine indicators returned with a prediction, in response order
KEY_FEATURES: tuple[str, ...] = (
    "total_meal_logs",
    "total_weight_logs",
    "total_exercise_logs",
    "meal_compliance_rate",
    "collection_completion_rate",
    "engagement_score",
    "enrollment_age_days",
    "days_since_last_meal",
    "days_since_last_weight",
)

# daily timeline window: as_of - 30 days ... as_of
TIMELINE_DAYS = 31

# model names in comparison order (ties on F1 go to the earliest)
MODEL_ORDER: tuple[str, ...] = ("Logistic Regression", "Random Forest", "Gradient Boosted Trees")

# serving limits
AT_RISK_DEFAULT_LIMIT = 100
AT_RISK_MAX_LIMIT = 500
SEARCH_DEFAULT_LIMIT = 20
SEARCH_MAX_LIMIT = 100
RISK_TABLE_ROWS = 50
TOP_FEATURES = 15
