"""Daily activity timelines: 31 zero-filled days per member, plus summaries.

Logs are first reduced to one row per (member, day) with partial aggregation
(a member with very many logs still yields at most 31 rows), then to one row
per member holding its active days; quiet days are filled in within the row.
Every per-member collection is bounded by the 31-day window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import as_of_lit
from cohortlens.sources.activity import ActivityData

DAY_FMT = "yyyy-MM-dd"


def _window(logs: DataFrame, as_of: dt.date, kind: str) -> DataFrame:
    start = as_of - dt.timedelta(days=K.TIMELINE_DAYS - 1)
    return (logs.where(F.col("log_date").between(as_of_lit(start), as_of_lit(as_of)))
            .select("member_id", F.col("log_date").alias("day"), F.lit(kind).alias("kind")))


def daily_counts(data: ActivityData) -> DataFrame:
    """(member, day) -> counts per channel, only days with activity."""
    logs = (_window(data.meals, data.as_of, "meal")
            .unionByName(_window(data.weights, data.as_of, "weight"))
            .unionByName(_window(data.exercises, data.as_of, "exercise"))
            .unionByName(_window(data.collections, data.as_of, "collection")))
    kind = F.col("kind")
    return logs.groupBy("member_id", "day").agg(
        F.count_if(kind == "meal").cast("int").alias("meal_count"),
        (F.count_if(kind == "weight") > 0).alias("weight_logged"),
        F.count_if(kind == "exercise").cast("int").alias("exercise_count"),
        F.count_if(kind == "collection").cast("int").alias("collection_progress"),
    )


def member_days(data: ActivityData) -> DataFrame:
    """One row per member with ``days``: 31 ordered structs, zeros on quiet days.

    The active days of a member (31 at most) become a map; the calendar is
    filled from it within the row, without a member x day grid.
    """
    as_of = data.as_of
    start = as_of - dt.timedelta(days=K.TIMELINE_DAYS - 1)
    counts = daily_counts(data)
    values = F.struct(*[c for c in counts.columns if c not in ("member_id", "day")])
    known = counts.groupBy("member_id").agg(
        F.map_from_entries(F.collect_list(F.struct("day", values))).alias("known"))

    def filled(day: Column) -> Column:
        v = F.try_element_at(F.col("known"), day)
        return F.struct(
            day.alias("day"),
            F.coalesce(v["meal_count"], F.lit(0)).alias("meal_count"),
            F.coalesce(v["weight_logged"], F.lit(False)).alias("weight_logged"),
            F.coalesce(v["exercise_count"], F.lit(0)).alias("exercise_count"),
            F.coalesce(v["collection_progress"], F.lit(0)).alias("collection_progress"))

    calendar = F.sequence(as_of_lit(start), as_of_lit(as_of), F.expr("INTERVAL 1 DAY"))
    return data.members.select("member_id").join(known, "member_id", "left").select(
        "member_id", F.transform(calendar, filled).alias("days"))


def daily_activity(data: ActivityData) -> DataFrame:
    """One row per member and day, as_of - 30 ... as_of, zeros on quiet days."""
    return member_days(data).select("member_id", F.inline("days"))


def _summary(days: Column) -> Column:
    """Active days (meal, weight or exercise; collection alone does not count),
    totals, and the active share of the 31 days."""
    def total(name: str) -> Column:
        return F.aggregate(days, F.lit(0), lambda a, d: a + d[name])

    active = F.size(F.filter(days, lambda d: (d["meal_count"] > 0) | d["weight_logged"] | (d["exercise_count"] > 0)))
    return F.struct(
        F.lit(K.TIMELINE_DAYS).alias("period_days"), active.alias("active_days"),
        total("meal_count").alias("total_meals_logged"),
        F.size(F.filter(days, lambda d: d["weight_logged"])).alias("weight_log_days"),
        total("exercise_count").alias("total_exercises"),
        F.round(active / F.lit(float(K.TIMELINE_DAYS)), 4).alias("activity_rate"))


def timeline_summary(days: DataFrame) -> DataFrame:
    """The summary columns of each member of ``member_days``."""
    return days.select("member_id", _summary(F.col("days")).alias("s")).select("member_id", "s.*")


def enrollment_date(data: ActivityData) -> DataFrame:
    """as_of minus the enrollment age, as text; NULL when never enrolled."""
    e = data.enrollments.groupBy("member_id").agg(F.max("start_date").alias("start_date"))
    days = F.datediff(as_of_lit(data.as_of), F.col("start_date"))
    return e.select("member_id", F.date_format(F.date_sub(as_of_lit(data.as_of), days), DAY_FMT)
                    .alias("enrollment_date"))


def member_timeline(data: ActivityData) -> DataFrame:
    """One nested record per member: name, enrollment date, 31 ordered days, summary."""
    shown = F.transform("days", lambda d: F.struct(
        F.date_format(d["day"], DAY_FMT).alias("date"), d["meal_count"].alias("meal_count"),
        d["weight_logged"].alias("weight_logged"), d["exercise_count"].alias("exercise_count"),
        d["collection_progress"].alias("collection_progress")))
    days = member_days(data).select(
        "member_id", shown.alias("activity_timeline"), _summary(F.col("days")).alias("summary"))
    names = data.members.select(
        "member_id", F.coalesce(F.col("member_name"), F.lit("Unknown")).alias("member_name"))
    return names.join(enrollment_date(data), "member_id", "left").join(days, "member_id", "left")


def member_activity(timelines: DataFrame, member_id) -> DataFrame:
    """One member's timeline record; zero rows when unknown."""
    return timelines.where(F.col("member_id") == F.lit(member_id))
