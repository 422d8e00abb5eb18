import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.session import build_session, clear_scratch  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
AS_OF = dt.date(2024, 3, 31)


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    clear_scratch(s)
    s.stop()


def make_activity(spark, members, enrollments=(), meals=(), weights=(), exercises=(),
                  collections=(), as_of=AS_OF):
    """ActivityData from small row lists (standard column order)."""
    from cohortlens.sources.activity import ActivityData
    schemas = {
        "members": "member_id long, member_name string, gender string, birth_date date, "
                   "height_cm double, initial_weight_kg double, medical_conditions string, "
                   "allergies string, created_at timestamp",
        "enrollments": "member_id long, start_date date, is_active boolean, doctor_id long, "
                       "nutritionist_id long, fitness_coach_id long",
        "meals": "member_id long, log_date date, meal_type string, calories double, "
                 "protein_g double, carbs_g double, fat_g double, is_compliant boolean",
        "weights": "member_id long, log_date date, log_id long, weight_kg double",
        "exercises": "member_id long, log_date date, exercise_type string, minutes int, "
                     "calories_burned double, steps long",
        "collections": "member_id long, item_id long, log_date date, is_completed boolean, "
                       "is_unlocked boolean, progress_percent double",
    }
    rows = dict(members=members, enrollments=enrollments, meals=meals, weights=weights,
                exercises=exercises, collections=collections)
    frames = {k: spark.createDataFrame(list(v), schemas[k]) for k, v in rows.items()}
    return ActivityData(as_of=as_of, **frames).validate()


def member_row(mid, name="A B", created=None, height=170.0):
    return (mid, name, "male", dt.date(1990, 1, 1), height, 80.0, None, "", created)
