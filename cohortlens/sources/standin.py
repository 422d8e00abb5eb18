"""Stand-in activity sources over the driver's test tables.

The reference reads member, enrollment and four activity-log tables from a
relational database. The test data has none of them, so two deterministic
profiles map the given tables onto the standard activity columns
(``cohortlens.sources.activity``). Both profiles are plain projections,
filters and joins, so their work grows with the tables.

Orders profile (labels, features, models), as of 2001-08-02:
  member      = customer (name: part name with p_partkey = c_custkey)
  enrollment  = first order date; providers from account balance, segment, nation
  meals       = '1-URGENT' orders joined to their line items
  weights     = '2-HIGH' orders, exercises = '3-MEDIUM' orders,
  collections = '4-NOT SPECIFIED' and '5-LOW' orders.

Events profile (daily timelines), as of 2024-01-31:
  member = user_id; view -> meal, click -> weight, purchase -> exercise,
  error -> exercise of a second type, signup -> collection.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.activity import ActivityData
from cohortlens.sources.files import read_table

# --- fixed values: stand-in profile parameters -------------------------------
ORDERS_AS_OF = dt.date(2001, 8, 2)
ORDERS_THRESHOLD_DAYS = 180
EVENTS_AS_OF = dt.date(2024, 1, 31)
EVENTS_THRESHOLD_DAYS = 14
MEAL_PRIORITY = "1-URGENT"
WEIGHT_PRIORITY = "2-HIGH"
EXERCISE_PRIORITY = "3-MEDIUM"
COLLECTION_PRIORITIES = ("4-NOT SPECIFIED", "5-LOW")
MEAL_EVENT, WEIGHT_EVENT, COLLECTION_EVENT = "view", "click", "signup"
EXERCISE_EVENTS = ("purchase", "error")


def _before_next_day(df: DataFrame, ts: str, as_of: dt.date) -> F.Column:
    """``ts`` earlier than the day after ``as_of``, as a plain comparison with a
    literal of the column's own type (wall-clock for TIMESTAMP_NTZ, session
    time zone for TIMESTAMP), so it is constant-folded and reaches the scan."""
    bound = f"{(as_of + dt.timedelta(days=1)).isoformat()} 00:00:00"
    return F.col(ts) < F.lit(bound).cast(df.schema[ts].dataType)


def _demographics(key: F.Column, as_of: dt.date) -> dict[str, F.Column]:
    """Member attributes derived from the numeric key (deterministic)."""
    return {
        "birth_date": F.add_months(F.lit(as_of), -12 * (F.lit(18) + key % 58).cast("int")),
        "height_cm": (F.lit(140) + key % 56).cast("double"),
        "initial_weight_kg": (F.lit(45) + key % 106).cast("double"),
        "medical_conditions": F.when(key % 3 > 0, F.lit("listed")),
        "allergies": F.when(key % 10 < 3, F.lit("listed")),
    }


def orders_profile(spark: SparkSession, sf_dir: str, as_of: dt.date = ORDERS_AS_OF) -> ActivityData:
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    orders = orders.where(_before_next_day(orders, "o_orderdate", as_of))

    first_order = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order_ts"))
    base = customer.join(first_order, customer.c_custkey == first_order.o_custkey, "left")
    key = F.col("c_custkey")
    demo = _demographics(key, as_of)
    members = base.join(part, customer.c_custkey == part.p_partkey, "left").select(
        key.alias("member_id"),
        F.col("p_name").alias("member_name"),
        F.when(F.col("c_nationkey") % 2 == 1, F.lit("male")).otherwise(F.lit("female")).alias("gender"),
        *[c.alias(n) for n, c in demo.items()],
        F.col("first_order_ts").alias("created_at"),
    )
    enrollments = base.select(
        key.alias("member_id"),
        F.to_date("first_order_ts").alias("start_date"),
        (key % 20 > 0).alias("is_active"),
        F.when(F.col("c_acctbal") > 0, key).alias("doctor_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", key).alias("nutritionist_id"),
        F.when(F.col("c_nationkey") % 3 == 0, key).alias("fitness_coach_id"),
    )

    def channel(*priorities: str) -> DataFrame:
        return orders.where(F.col("o_orderpriority").isin(*priorities))

    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_extendedprice", "l_quantity", "l_tax", "l_discount")
    meal_orders = channel(MEAL_PRIORITY)
    meals = meal_orders.join(lineitem, meal_orders.o_orderkey == lineitem.l_orderkey).select(
        F.col("o_custkey").alias("member_id"),
        F.to_date("o_orderdate").alias("log_date"),
        F.col("l_returnflag").alias("meal_type"),
        F.col("l_extendedprice").alias("calories"),
        F.col("l_quantity").alias("protein_g"),
        (F.col("l_tax") * 100).alias("carbs_g"),
        (F.col("l_discount") * 100).alias("fat_g"),
        (F.col("l_discount") < 0.05).alias("is_compliant"),
    )
    weights = channel(WEIGHT_PRIORITY).select(
        F.col("o_custkey").alias("member_id"),
        F.to_date("o_orderdate").alias("log_date"),
        F.col("o_orderkey").alias("log_id"),
        (F.col("o_totalprice") / 4000).alias("weight_kg"),
    )
    exercises = channel(EXERCISE_PRIORITY).select(
        F.col("o_custkey").alias("member_id"),
        F.to_date("o_orderdate").alias("log_date"),
        F.col("o_orderstatus").alias("exercise_type"),
        F.floor(F.col("o_totalprice") / 8000).cast("int").alias("minutes"),
        (F.col("o_totalprice") / 1000).alias("calories_burned"),
        (F.col("o_orderkey") % 8000).alias("steps"),
    )
    status = F.col("o_orderstatus")
    collections = channel(*COLLECTION_PRIORITIES).select(
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderkey").alias("item_id"),
        F.to_date("o_orderdate").alias("log_date"),
        (status == "F").alias("is_completed"),
        status.isin("F", "P").alias("is_unlocked"),
        F.when(status == "F", F.lit(100.0)).when(status == "P", F.lit(50.0))
         .otherwise(F.lit(0.0)).alias("progress_percent"),
    )
    return ActivityData(members, enrollments, meals, weights, exercises, collections, as_of).validate()


def events_profile(spark: SparkSession, sf_dir: str, as_of: dt.date = EVENTS_AS_OF) -> ActivityData:
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    events = events.where(_before_next_day(events, "ts", as_of))
    first_seen = events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    base = first_seen.join(part, first_seen.user_id == part.p_partkey, "left")
    key = F.col("user_id")
    demo = _demographics(key, as_of)
    members = base.select(
        key.alias("member_id"),
        F.col("p_name").alias("member_name"),
        F.when(key % 2 == 1, F.lit("male")).otherwise(F.lit("female")).alias("gender"),
        *[c.alias(n) for n, c in demo.items()],
        F.col("first_ts").alias("created_at"),
    )
    enrollments = base.select(
        key.alias("member_id"),
        F.to_date("first_ts").alias("start_date"),
        (key % 20 > 0).alias("is_active"),
        F.when(key % 2 == 0, key).alias("doctor_id"),
        F.when(key % 3 == 0, key).alias("nutritionist_id"),
        F.when(key % 5 == 0, key).alias("fitness_coach_id"),
    )

    def channel(*kinds: str) -> DataFrame:
        return events.where(F.col("event_type").isin(*kinds))

    member, day, value = F.col("user_id").alias("member_id"), F.to_date("ts").alias("log_date"), F.col("value")
    meals = channel(MEAL_EVENT).select(
        member, day, F.col("event_type").alias("meal_type"), value.alias("calories"),
        F.lit(None).cast("double").alias("protein_g"), F.lit(None).cast("double").alias("carbs_g"),
        F.lit(None).cast("double").alias("fat_g"), (value < 50).alias("is_compliant"))
    weights = channel(WEIGHT_EVENT).select(
        member, day, F.col("event_id").alias("log_id"), value.alias("weight_kg"))
    exercises = channel(*EXERCISE_EVENTS).select(
        member, day, F.col("event_type").alias("exercise_type"),
        F.floor(value).cast("int").alias("minutes"), value.alias("calories_burned"),
        F.col("event_id").alias("steps"))
    collections = channel(COLLECTION_EVENT).select(
        member, F.col("event_id").alias("item_id"), day,
        (value >= 50).alias("is_completed"), F.lit(True).alias("is_unlocked"),
        value.alias("progress_percent"))
    return ActivityData(members, enrollments, meals, weights, exercises, collections, as_of).validate()
