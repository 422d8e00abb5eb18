"""Dashboard projections, as report columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators.scoring import rank_order, risk_filter


def chart_rows(daily: DataFrame) -> DataFrame:
    """Chart series per day: MM-dd label, weight as 1/0."""
    return daily.select(
        "member_id", F.date_format("day", "MM-dd").alias("date"), "meal_count",
        F.col("weight_logged").cast("int").alias("weight"), "exercise_count",
        "collection_progress")


def gauge_band(predictions: DataFrame) -> DataFrame:
    """Whole-percent gauge value and its band (>= 60 high, >= 30 medium, else low).

    The band uses the rounded percent, so .295 shows as medium here while its
    risk label is Low.
    """
    pct = F.round(F.coalesce(F.col("churn_probability"), F.lit(0.0)) * 100).cast("int")
    return predictions.select(
        "member_id", pct.alias("gauge_percent"),
        F.when(pct >= 60, "high").when(pct >= 30, "medium").otherwise("low").alias("gauge_band"))


def risk_table(predictions: DataFrame, label: str | None = None,
               rows: int = K.RISK_TABLE_ROWS) -> DataFrame:
    """Top rows of the (filtered) ranked list, formatted for display."""
    top = risk_filter(predictions, label).orderBy(*rank_order()).limit(rows)
    return top.select(
        F.coalesce(F.col("member_name"), F.lit("—")).alias("display_name"),
        F.concat(F.substring(F.col("member_id").cast("string"), 1, 8), F.lit("...")).alias("short_id"),
        F.format_string("%.1f%%", (F.col("churn_probability") * 100).cast("double")).alias("probability_text"),
        F.lower("risk_label").alias("risk_class"),
    )


def key_indicators(predictions: DataFrame) -> DataFrame:
    """Six displayed indicators: four rounded counts, two whole-percent strings."""
    def pct(c):
        return F.concat(F.round(F.col(c) * 100).cast("long").cast("string"), F.lit("%"))
    return predictions.select(
        "member_id",
        F.round("total_meal_logs").cast("long").alias("meals_logged"),
        F.round("total_weight_logs").cast("long").alias("weight_logs"),
        F.round("total_exercise_logs").cast("long").alias("exercise_logs"),
        pct("meal_compliance_rate").alias("meal_compliance"),
        pct("collection_completion_rate").alias("completion_rate"),
        F.round("enrollment_age_days").cast("long").alias("days_enrolled"),
    )


def search_display(results: DataFrame) -> DataFrame:
    """Search hit label: "first last" trimmed, else a placeholder; id prefix 12."""
    first = F.coalesce(F.col("first_name"), F.lit(""))
    last = F.coalesce(F.col("last_name"), F.lit(""))
    has_name = (first != "") | (last != "")
    return results.select(
        "member_id",
        F.when(has_name, F.trim(F.concat(first, F.lit(" "), last)))
         .otherwise(F.lit("Unnamed Member")).alias("display_name"),
        F.concat(F.substring(F.col("member_id").cast("string"), 1, 12), F.lit("...")).alias("short_id"),
    )
