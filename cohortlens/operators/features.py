"""Activity-log aggregation: the 42 base features, one row per member.

Each channel is one ``groupBy(member_id).agg(...)``: partial aggregation runs
before the shuffle, so a member holding a large share of all logs costs one
pre-aggregated row per map task, not its raw rows. Distinct days and types
are merged as sets, bounded by the calendar and the list of types. All channel
results come out hash-partitioned on ``member_id``, so the final left joins to
the member table reuse that partitioning.

Logs dated after ``as_of`` are dropped in every channel first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import as_of_lit, days_before, flag, present, safe_rate
from cohortlens.sources.activity import ActivityData

KEY = "member_id"


def _until(logs: DataFrame, as_of: dt.date) -> DataFrame:
    return logs.where(F.col("log_date") <= as_of_lit(as_of))


def _rounded_mean(total: Column, count: Column, digits: int) -> Column:
    """total / count; the first rounding takes out the noise of the summing order,
    so a mean that lies on a rounding boundary does not depend on it."""
    return F.round(F.round(total / count, 6), digits)


def _recency(as_of: dt.date) -> Column:
    return days_before(as_of, F.max("log_date"))


def _distinct(c: str) -> Column:
    """Distinct values of a column with few of them, merged as sets (no second shuffle)."""
    return F.size(F.collect_set(c)).cast("long")


# --- members and enrollments --------------------------------------------------

def member_demographics(members: DataFrame, as_of: dt.date,
                        keep: tuple[str, ...] = ()) -> DataFrame:
    """gender_encoded (1 = male), whole years of age, body size, 0/1 flags.

    ``keep`` passes member columns through (``height_cm_raw`` is the height
    as stored, for BMI).
    """
    gender = F.lower(F.trim(F.col("gender")))
    passed = [F.col("height_cm").alias(c) if c == "height_cm_raw" else F.col(c) for c in keep]
    return members.select(
        KEY, *passed,
        flag(gender.isin("male", "m")).alias("gender_encoded"),
        F.floor(F.months_between(as_of_lit(as_of), F.col("birth_date")) / 12).cast("int")
         .alias("age_years"),
        F.col("height_cm").cast("double").alias("height_cm"),
        F.col("initial_weight_kg").cast("double").alias("initial_weight_kg"),
        present(F.col("medical_conditions")).alias("has_medical_conditions"),
        present(F.col("allergies")).alias("has_allergies"),
    )


def _latest_enrollment(enrollments: DataFrame) -> DataFrame:
    """One whole enrollment row per member: the latest by start date, ties by the
    larger fields in order (a missing value is the smallest). The total order
    makes the choice independent of the row order."""
    fields = ("is_active", "doctor_id", "nutritionist_id", "fitness_coach_id")
    latest = F.max(F.struct("start_date", *fields)).alias("e")
    return enrollments.groupBy(KEY).agg(latest).select(KEY, "e.*")


def enrollment_features(enrollments: DataFrame, as_of: dt.date) -> DataFrame:
    """enrollment_age_days (as_of - start), is_enrolled_active and the three
    provider flags (has_doctor / has_nutritionist / has_fitness_coach), 0/1."""
    e = _latest_enrollment(enrollments)
    return e.select(
        KEY,
        days_before(as_of, F.col("start_date")).alias("enrollment_age_days"),
        flag(F.col("is_active")).alias("is_enrolled_active"),
        flag(F.col("doctor_id").isNotNull()).alias("has_doctor"),
        flag(F.col("nutritionist_id").isNotNull()).alias("has_nutritionist"),
        flag(F.col("fitness_coach_id").isNotNull()).alias("has_fitness_coach"),
    )


def provider_flags(enrollments: DataFrame, as_of: dt.date) -> DataFrame:
    return enrollment_features(enrollments, as_of).select(KEY, *K.PROVIDER_COLUMNS)


# --- meal channel ---------------------------------------------------------------

def meal_features(meals: DataFrame, as_of: dt.date) -> DataFrame:
    """All eleven meal features from one pass over the log and one shuffle.

    Every aggregate combines before the shuffle, so a member holding a large
    share of the log costs one partial row per map task. The sets stay small:
    days are those of the calendar, types a short list of the application.
    """
    def mean(c: Column, digits: int) -> Column:
        return _rounded_mean(F.sum(c), F.count(c), digits)

    def recent(days: int) -> Column:
        return F.count_if(days_before(as_of, F.col("log_date")).between(0, days))

    return _until(meals, as_of).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("total_meal_logs"),
        _distinct("log_date").alias("distinct_meal_days"),
        mean(F.col("calories"), 1).alias("avg_calories_per_meal"),
        mean(F.col("protein_g"), 1).alias("avg_protein_g"),
        mean(F.col("carbs_g"), 1).alias("avg_carbs_g"),
        mean(F.col("fat_g"), 1).alias("avg_fat_g"),
        _distinct("meal_type").alias("distinct_meal_types"),
        mean(F.col("is_compliant").cast("double"), 4).alias("meal_compliance_rate"),
        _recency(as_of).alias("days_since_last_meal"),
        recent(7).alias("meals_last_7_days"),
        recent(14).alias("meals_last_14_days"),
    )


def meal_totals(meals: DataFrame, as_of: dt.date) -> DataFrame:
    return meal_features(meals, as_of).select(
        KEY, "total_meal_logs", "distinct_meal_days", "distinct_meal_types")


def meal_nutrition(meals: DataFrame, as_of: dt.date) -> DataFrame:
    return meal_features(meals, as_of).select(
        KEY, "avg_calories_per_meal", "avg_protein_g", "avg_carbs_g", "avg_fat_g")


def meal_compliance(meals: DataFrame, as_of: dt.date) -> DataFrame:
    """Share of compliant meals (the reference formula is unknown; avg of the flag)."""
    return meal_features(meals, as_of).select(KEY, "meal_compliance_rate")


def meal_recent_counts(meals: DataFrame, as_of: dt.date) -> DataFrame:
    """Meals logged in the last 7 / 14 days, both ends inclusive."""
    return meal_features(meals, as_of).select(KEY, "meals_last_7_days", "meals_last_14_days")


# --- weight channel ---------------------------------------------------------------

def weight_aggregates(weights: DataFrame, as_of: dt.date) -> DataFrame:
    """Per-member weight statistics, without BMI (that needs the member's height).

    Two hash aggregations instead of one distinct aggregation: logs are first
    reduced to one row per (member, day), keeping that day's first and last
    weight by log id; the per-member step then counts days without a
    distinct, and picks the first/last weight by day. Every ordering key is a
    fixed-width primitive, so both steps stay hash aggregations with partial
    (map-side) combining, and a member with very many logs is spread over
    its days in the first shuffle.
    """
    def weighed(c: str) -> Column:  # rows without a weight are not ranked
        return F.when(F.col("weight_kg").isNotNull(), F.col(c))

    day = _until(weights, as_of).groupBy(KEY, "log_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("weight_kg").alias("w_sum"),
        F.count("weight_kg").alias("w_cnt"),
        F.max("weight_kg").alias("w_max"),
        F.min("weight_kg").alias("w_min"),
        F.min_by("weight_kg", weighed("log_id")).alias("w_first"),
        F.max_by("weight_kg", weighed("log_id")).alias("w_last"),
    )
    weighed_day = F.when(F.col("w_cnt") > 0, F.col("log_date"))
    return day.groupBy(KEY).agg(
        F.sum("n").alias("total_weight_logs"),
        F.count(F.lit(1)).alias("distinct_weight_days"),
        F.round(F.max("w_max") - F.min("w_min"), 2).alias("weight_range_kg"),
        (F.sum("w_sum") / F.sum("w_cnt")).alias("_avg_weight"),
        _recency(as_of).alias("days_since_last_weight"),
        F.round(F.max_by("w_last", weighed_day) - F.min_by("w_first", weighed_day), 2)
         .alias("weight_change_kg"),
    )


def bmi_expr(avg_weight: Column, height_cm: Column) -> Column:
    """Mean BMI from the mean weight: height is constant per member, so
    mean(w / h^2) = mean(w) / h^2. NULL for a missing or zero height."""
    h = height_cm.cast("double")
    return _rounded_mean(F.when(h > 0, avg_weight), F.pow(h / 100, 2), 1)


_WEIGHT_OUT = ("total_weight_logs", "distinct_weight_days", "weight_range_kg", "avg_bmi",
               "days_since_last_weight", "weight_change_kg")


def weight_features(weights: DataFrame, members: DataFrame, as_of: dt.date) -> DataFrame:
    """Weight counts, range, first-to-last change, mean BMI, recency.

    The log table is aggregated first; only the per-member result meets the
    member table for the height.
    """
    agg = weight_aggregates(weights, as_of)
    height = members.select(KEY, "height_cm")
    return agg.join(height, KEY, "left").select(
        KEY, *[bmi_expr(F.col("_avg_weight"), F.col("height_cm")).alias(c) if c == "avg_bmi"
               else F.col(c) for c in _WEIGHT_OUT])


# --- exercise channel ---------------------------------------------------------------

def exercise_features(exercises: DataFrame, as_of: dt.date) -> DataFrame:
    """Exercise features from one shuffle by member, like the meals."""
    return _until(exercises, as_of).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("total_exercise_logs"),
        _distinct("log_date").alias("distinct_exercise_days"),
        F.sum("minutes").cast("long").alias("total_exercise_minutes"),
        _rounded_mean(F.sum("minutes"), F.count("minutes"), 1).alias("avg_exercise_minutes"),
        _rounded_mean(F.sum("calories_burned"), F.lit(1), 1).alias("total_calories_burned"),
        F.sum("steps").cast("long").alias("total_steps"),
        _recency(as_of).alias("days_since_last_exercise"),
        _distinct("exercise_type").alias("distinct_exercise_types"),
    )


# --- collection channel ---------------------------------------------------------------

def collection_features(collections: DataFrame, as_of: dt.date) -> DataFrame:
    agg = _until(collections, as_of).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("total_collection_items"),
        F.count_if(F.col("is_completed")).alias("completed_items"),
        F.round(F.avg("progress_percent"), 1).alias("avg_progress_percent"),
        F.count_if(F.col("is_unlocked")).alias("unlocked_items"),
        _recency(as_of).alias("days_since_last_collection"),
    )
    return agg.select(
        KEY, "total_collection_items", "completed_items",
        F.round(safe_rate(F.col("completed_items"), F.col("total_collection_items")), 4)
         .alias("collection_completion_rate"),
        "avg_progress_percent", "unlocked_items", "days_since_last_collection")


def channel_recency(data: ActivityData) -> DataFrame:
    """Days since the last log per channel; 9999 when a channel has no log.

    The latest days of all four channels come from one aggregation of their
    union, so one shuffle by member serves them all.
    """
    as_of = data.as_of
    logs = (data.meals, data.weights, data.exercises, data.collections)
    days = None
    for channel, df in zip(K.RECENCY_COLUMNS, logs):
        part = _until(df, as_of).select(KEY, F.lit(channel).alias("channel"), "log_date")
        days = part if days is None else days.unionByName(part)
    latest = days.groupBy(KEY).agg(*[
        days_before(as_of, F.max(F.when(F.col("channel") == c, F.col("log_date")))).alias(c)
        for c in K.RECENCY_COLUMNS])
    return data.members.select(KEY).join(latest, KEY, "left").select(
        KEY, *[F.coalesce(c, F.lit(K.RECENCY_SENTINEL)).alias(c) for c in K.RECENCY_COLUMNS])


# --- the whole table ---------------------------------------------------------------

# columns that become 0 for members without logs in a channel
_ZERO_WHEN_ABSENT = (
    "total_meal_logs", "distinct_meal_days", "distinct_meal_types", "meals_last_7_days",
    "meals_last_14_days", "total_weight_logs", "distinct_weight_days", "total_exercise_logs",
    "distinct_exercise_days", "total_exercise_minutes", "total_calories_burned", "total_steps",
    "distinct_exercise_types", "total_collection_items", "completed_items",
    "collection_completion_rate", "unlocked_items",
)
_DOUBLE_ZERO = {"total_calories_burned", "collection_completion_rate"}


def feature_table(data: ActivityData, with_name: bool = False) -> DataFrame:
    """member_id + the 42 base features for every member, logs or not.

    The member table is read once (demographics are columns of it), and the
    enrollment and four channel aggregates are left-joined to it on
    member_id; each aggregate leaves hash-partitioned on member_id, so the
    join chain adds no shuffle of its own beyond the member table's.
    Counts are 0 and recencies 9999 for a channel without logs; averages
    stay NULL so that imputation can fill them. ``created_at`` is kept for
    ordering (the reference lists newest members first).
    """
    as_of = data.as_of
    return assemble(data.members, as_of, [
        enrollment_features(data.enrollments, as_of),
        meal_features(data.meals, as_of),
        weight_aggregates(data.weights, as_of),
        exercise_features(data.exercises, as_of),
        collection_features(data.collections, as_of),
    ], with_name)


def assemble(members: DataFrame, as_of: dt.date, parts: list[DataFrame], with_name: bool = False) -> DataFrame:
    """The feature table from the members and the enrollment and channel aggregates."""
    base = member_demographics(members, as_of, keep=(
        "created_at", "height_cm_raw") + (("member_name",) if with_name else ()))
    table = base
    for part in parts:
        table = table.join(part, KEY, "left")
    table = table.withColumn("avg_bmi", bmi_expr(F.col("_avg_weight"), F.col("height_cm_raw")))
    cols: list[Column] = [F.col(KEY)]
    if with_name:
        cols.append(F.col("member_name"))
    for name in K.BASE_FEATURE_COLUMNS:
        c = F.col(name)
        if name in _ZERO_WHEN_ABSENT:
            zero = F.lit(0.0) if name in _DOUBLE_ZERO else F.lit(0)
            c = F.coalesce(c, zero)
        elif name in K.RECENCY_COLUMNS:
            c = F.coalesce(c, F.lit(K.RECENCY_SENTINEL))
        cols.append(c.alias(name))
    cols.append(F.col("created_at"))
    return table.select(*cols)


def order_newest_first(table: DataFrame) -> DataFrame:
    """The reference's row order: newest member first, ties by id."""
    return table.orderBy(F.col("created_at").desc_nulls_last(), F.col(KEY).asc())
