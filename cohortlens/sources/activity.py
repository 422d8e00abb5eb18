"""The member activity data model: one member table, one enrollment table and
four activity-log channels. Every operator in ``cohortlens.operators`` reads
these standard columns, whatever the physical source is.

members      member_id, member_name, gender, birth_date, height_cm,
             initial_weight_kg, medical_conditions, allergies, created_at
enrollments  member_id, start_date, is_active, doctor_id, nutritionist_id,
             fitness_coach_id
meals        member_id, log_date, meal_type, calories, protein_g, carbs_g,
             fat_g, is_compliant
weights      member_id, log_date, log_id, weight_kg
exercises    member_id, log_date, exercise_type, minutes, calories_burned, steps
collections  member_id, item_id, log_date, is_completed, is_unlocked,
             progress_percent
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.files import nan_to_null

MEMBER_COLUMNS = ("member_id", "member_name", "gender", "birth_date", "height_cm",
                  "initial_weight_kg", "medical_conditions", "allergies", "created_at")
ENROLLMENT_COLUMNS = ("member_id", "start_date", "is_active", "doctor_id",
                      "nutritionist_id", "fitness_coach_id")
MEAL_COLUMNS = ("member_id", "log_date", "meal_type", "calories", "protein_g",
                "carbs_g", "fat_g", "is_compliant")
WEIGHT_COLUMNS = ("member_id", "log_date", "log_id", "weight_kg")
EXERCISE_COLUMNS = ("member_id", "log_date", "exercise_type", "minutes",
                    "calories_burned", "steps")
COLLECTION_COLUMNS = ("member_id", "item_id", "log_date", "is_completed",
                      "is_unlocked", "progress_percent")


@dataclasses.dataclass(frozen=True)
class ActivityData:
    """Lazy DataFrames of one activity source plus its reference date."""

    members: DataFrame
    enrollments: DataFrame
    meals: DataFrame
    weights: DataFrame
    exercises: DataFrame
    collections: DataFrame
    as_of: dt.date

    def validate(self) -> "ActivityData":
        """Check the columns; NaN becomes NULL in every table."""
        expected = {
            "members": MEMBER_COLUMNS, "enrollments": ENROLLMENT_COLUMNS,
            "meals": MEAL_COLUMNS, "weights": WEIGHT_COLUMNS,
            "exercises": EXERCISE_COLUMNS, "collections": COLLECTION_COLUMNS,
        }
        for name, cols in expected.items():
            missing = set(cols) - set(getattr(self, name).columns)
            if missing:
                raise ValueError(f"{name} lacks columns {sorted(missing)}")
        return dataclasses.replace(self, **{name: nan_to_null(getattr(self, name)) for name in expected})


def log_batch(data: ActivityData, after: dt.date | None, until: dt.date) -> ActivityData:
    """The logs dated later than ``after`` (None: from the start) up to ``until``, the batch's reference date."""
    dated = F.col("log_date") <= F.lit(until)
    if after is not None:
        dated = dated & (F.col("log_date") > F.lit(after))
    return dataclasses.replace(data, as_of=until, **{
        c: getattr(data, c).where(dated) for c in ("meals", "weights", "exercises", "collections")})
