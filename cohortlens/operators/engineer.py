"""Feature engineering: the nine derived model features.

Global statistics (channel maxima) are one-row aggregates. They are fitted
once (an action returning a single row) and applied as literals, the same
fit/transform split Spark ML uses; at serving time the saved training maxima
are reused instead of the scored batch's own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import decay_score, flag, safe_rate


def channel_maxima(df: DataFrame) -> DataFrame:
    """One row: the maximum of each channel total, 1 when not positive."""
    return df.agg(*[F.greatest(F.max(c), F.lit(1)).alias(f"max_{c}") for c in K.ACTIVITY_COLUMNS])


def fit_channel_maxima(df: DataFrame) -> dict[str, float]:
    row = channel_maxima(df).first()
    return {c: float(row[f"max_{c}"] if row[f"max_{c}"] is not None else 1) for c in K.ACTIVITY_COLUMNS}


def engagement_score(df: DataFrame, maxima: dict[str, float] | None = None) -> DataFrame:
    """Weighted sum of the four channel totals, each divided by its maximum.

    ``maxima=None`` fits them on ``df`` (training); pass saved maxima to score
    new members consistently with training.
    """
    maxima = maxima or fit_channel_maxima(df)
    terms = [F.lit(w) * (F.col(c) / F.lit(float(maxima[c])))
             for w, c in zip(K.ENGAGEMENT_WEIGHTS, K.ACTIVITY_COLUMNS)]
    return df.withColumn("engagement_score", reduce(lambda a, b: a + b, terms))


def recency_decay(df: DataFrame) -> DataFrame:
    """``exp(-0.05 * min(days, 365))`` for each recency column present."""
    return df.withColumns({score: decay_score(F.col(days)) for days, score in K.RECENCY_SCORES.items()
                           if days in df.columns})


def logging_rates(df: DataFrame) -> DataFrame:
    """Distinct logging days per enrolled day; 0 when enrollment is not positive."""
    return df.withColumns({rate: safe_rate(F.col(days), F.col("enrollment_age_days"))
                           for days, rate in K.LOGGING_RATES.items()})


def has_recent_meals(df: DataFrame) -> DataFrame:
    """1 when a meal was logged in the last 7 days (missing counts as 0)."""
    if "meals_last_7_days" not in df.columns:
        raise ValueError("has_recent_meals needs meals_last_7_days")
    return df.withColumn("has_recent_meals", flag(F.col("meals_last_7_days") > 0))


def provider_count(df: DataFrame) -> DataFrame:
    cols = [F.col(c) for c in K.PROVIDER_COLUMNS if c in df.columns]
    return df.withColumn("provider_count", reduce(lambda a, b: a + b, cols)) if cols else df


def engineer_features(df: DataFrame, maxima: dict[str, float] | None = None) -> DataFrame:
    """All derived features, in model order."""
    return (df.transform(lambda d: engagement_score(d, maxima))
              .transform(recency_decay)
              .transform(logging_rates)
              .transform(has_recent_meals)
              .transform(provider_count))
