"""Scoring and serving queries over a prediction table.

A prediction table has one row per member with at least ``member_id``,
``churn_probability`` (rounded to 4 places), ``churn_prediction``,
``risk_label`` and ``created_at``. Ranked lists are ``orderBy(...).limit(n)``,
which Spark plans as a distributed top-k (TakeOrderedAndProject): every task
keeps its own n best rows, never the whole table.
"""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import risk_bucket

_RISK_PATTERN = re.compile(r"^(Low|Medium|High)$")

# the reference keeps a stable sort on its input order (newest member first);
# that order is made explicit here, with the id as final tie-break
def rank_order() -> tuple[Column, ...]:
    return (F.col("churn_probability").desc(), F.col("created_at").desc_nulls_last(),
            F.col("member_id").asc())


def add_risk_label(df: DataFrame, probability: str = "probability_raw") -> DataFrame:
    """Risk band from the unrounded probability (0.29996 is Low, shown as 0.3)."""
    return df.withColumn("risk_label", risk_bucket(F.col(probability)))


def rank_by_risk(predictions: DataFrame) -> DataFrame:
    """Whole table sorted by rounded probability, descending (a range-partitioned sort)."""
    return predictions.orderBy(*rank_order())


def _check_risk_filter(risk_filter: str | None) -> None:
    if risk_filter is not None and not _RISK_PATTERN.match(risk_filter):
        raise ValueError(f"risk_filter must be Low, Medium or High, got {risk_filter!r}")


def risk_filter(predictions: DataFrame, label: str | None) -> DataFrame:
    """Keep one risk band; ``None`` keeps all."""
    _check_risk_filter(label)
    return predictions if label is None else predictions.where(F.col("risk_label") == F.lit(label))


def risk_summary(predictions: DataFrame) -> DataFrame:
    """Members per risk band (0 when none), as one row."""
    label = F.col("risk_label")
    return predictions.agg(
        F.count(F.lit(1)).alias("total_members"),
        F.count_if(label == "High").alias("high_risk"),
        F.count_if(label == "Medium").alias("medium_risk"),
        F.count_if(label == "Low").alias("low_risk"),
    )


def _check_limit(limit: int, hi: int) -> None:
    if not 1 <= limit <= hi:
        raise ValueError(f"limit must be within 1..{hi}, got {limit}")


def at_risk_top(predictions: DataFrame, limit: int = K.AT_RISK_DEFAULT_LIMIT,
                label: str | None = None) -> DataFrame:
    """The first ``limit`` members of the ranked, optionally filtered list."""
    _check_limit(limit, K.AT_RISK_MAX_LIMIT)
    top = risk_filter(predictions, label).orderBy(*rank_order()).limit(limit)
    return top.select("member_id", "member_name", "churn_probability", "churn_prediction",
                      "risk_label")


def at_risk_summary(predictions: DataFrame, limit: int = K.AT_RISK_DEFAULT_LIMIT,
                    label: str | None = None) -> DataFrame:
    """Band counts over the limited list only (as the reference reports them)."""
    return risk_summary(at_risk_top(predictions, limit, label))


def names_join(df: DataFrame, names: DataFrame, default: str = "") -> DataFrame:
    """Left lookup of ``member_name`` by id, with a default for unknown ids.

    ``names`` holds one row per member, so this is a key-to-key join that
    shuffles both sides on member_id (or broadcasts when Spark has measured
    the name table as small).
    """
    base = df.drop("member_name") if "member_name" in df.columns else df
    return (base.join(names.select("member_id", "member_name"), "member_id", "left")
            .withColumn("member_name", F.coalesce(F.col("member_name"), F.lit(default))))


def member_search(predictions: DataFrame, q: str = "", limit: int = K.SEARCH_DEFAULT_LIMIT) -> DataFrame:
    """Case-insensitive substring search on id or name, in risk order.

    ``contains`` compares literally, so ``%`` and ``_`` are not wildcards.
    The name splits at its first blank into first and last name; a member
    without a name gets empty strings, as in the reference.
    """
    _check_limit(limit, K.SEARCH_MAX_LIMIT)
    name = F.coalesce(F.col("member_name"), F.lit(""))
    hits = predictions
    if q:
        needle = F.lit(q.lower())
        hits = predictions.where(F.contains(F.lower(F.col("member_id").cast("string")), needle)
                                 | F.contains(F.lower(name), needle))
    parts = F.split(name, " ", 2)
    top = hits.orderBy(*rank_order()).limit(limit)
    return top.select(
        F.col("member_id"),
        F.when(name == "", F.lit("")).otherwise(F.get(parts, 0)).alias("first_name"),
        F.when(name == "", F.lit("")).otherwise(F.get(parts, 1)).alias("last_name"),
        F.date_format("created_at", "yyyy-MM-dd").alias("created_at"),
    )


def prediction_lookup(predictions: DataFrame, member_id) -> DataFrame:
    """The prediction of one member (zero rows means "not found")."""
    return predictions.where(F.col("member_id") == F.lit(member_id)).limit(1)


def key_features(predictions: DataFrame, defaults: dict[str, float] | None = None) -> DataFrame:
    """The nine indicators as one struct column; a missing value takes its default (0)."""
    defaults = defaults or {}
    fields = []
    for c in K.KEY_FEATURES:
        d = defaults.get(c, 0)
        value = F.col(c) if c in predictions.columns else F.lit(None)
        fields.append(F.coalesce(value, F.lit(d)).alias(c))
    return predictions.select("member_id", F.struct(*fields).alias("key_features"))


def key_features_scored(scored: DataFrame) -> DataFrame:
    """As ``key_features`` on scored model input: a recency that is not a model
    feature defaults to 9999 ("never") instead of 0."""
    return key_features(scored, {"days_since_last_meal": K.RECENCY_SENTINEL,
                                 "days_since_last_weight": K.RECENCY_SENTINEL})


def prediction_record(predictions: DataFrame) -> DataFrame:
    """The cached record per member: ids, scores, and nine typed indicators."""
    ints = ("total_meal_logs", "total_weight_logs", "total_exercise_logs",
            "enrollment_age_days", "days_since_last_meal", "days_since_last_weight")
    dbls = ("meal_compliance_rate", "collection_completion_rate", "engagement_score")
    return predictions.select(
        "member_id", "member_name", "churn_probability",
        F.col("churn_prediction").cast("int").alias("churn_prediction"), "risk_label",
        *[F.col(c).cast("int").alias(c) for c in ints],
        *[F.col(c).cast("double").alias(c) for c in dbls],
    )


# --- model scoring ---------------------------------------------------------------

def score_members(model: PipelineModel, features: DataFrame,
                  keep: tuple[str, ...] = ("member_id", "member_name", "created_at")) -> DataFrame:
    """Batch scoring with a fitted pipeline (assembler, scaler, classifier).

    Pure per-row work: the model is shipped once to every executor and each
    partition is scored where it lies, no shuffle.
    """
    out = model.transform(features)
    p = vector_to_array(F.col("probability"))[1]
    return out.select(
        *[c for c in keep if c in features.columns],
        F.round(p, 4).alias("churn_probability"),
        F.col("prediction").cast("int").alias("churn_prediction"),
        risk_bucket(p).alias("risk_label"),
        *[c for c in K.KEY_FEATURES if c in features.columns],
    )


def score_one(model: PipelineModel, features: DataFrame, member_id) -> DataFrame:
    """One member's prediction record; an unknown member gives one record with
    ``error`` set and no scores (a one-row probe left-joined to the result,
    so nothing is collected to decide it)."""
    scored = score_members(model, features.where(F.col("member_id") == F.lit(member_id)))
    spark = features.sparkSession
    probe = spark.range(1).select(F.lit(member_id).cast(features.schema["member_id"].dataType)
                                  .alias("member_id"))
    out = probe.join(scored, "member_id", "left")
    return out.withColumn("error", F.when(F.col("churn_probability").isNull(),
                                          F.lit("Member not found")))
