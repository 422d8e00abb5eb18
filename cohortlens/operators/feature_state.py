"""Channel aggregates kept as a mergeable state, so that a day's logs are added without the old ones.

A state is one row per member and channel: sums and counts, first and last
values, the distinct days and types (bounded by the calendar and the list of
types) and the meals of the last 15 days by age. ``partial`` makes it from
logs with map-side combining, ``merge`` adds states, ``finish`` turns it into
the columns of ``features``. ``advance`` keeps one version per batch under a
folder: a batch reads the version before it and writes its own, so running a
failed or repeated batch again gives the same state, and older versions can be
deleted once a later one is complete. Only members of the batch are merged by a
shuffle; the others' rows are copied, if the batch has few members.

Logs dated after a batch's ``as_of`` are left out, as in a full run; they
belong to the batch of their own day. Late logs, dated before earlier batches,
are added like others. Each log must be in one batch only. Weights without a
``log_id`` take no part in first and last weight.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import as_of_lit, days_before, safe_rate
from cohortlens.operators import features
from cohortlens.operators.features import KEY, _rounded_mean, _until
from cohortlens.session import materialize, path_exists
from cohortlens.sources.activity import ActivityData

RECENT_DAYS = 15
BROADCAST_MEMBERS = 500_000     # members of a batch whose ids may be broadcast
_MEAL_MEANS = {"calories": "avg_calories_per_meal", "protein_g": "avg_protein_g", "carbs_g": "avg_carbs_g",
               "fat_g": "avg_fat_g"}


# how two states' columns are added: name of the aggregate by column
_MERGE: dict[str, dict[str, str]] = {
    "meals": {"n": "sum", "days": "set", "types": "set", "last_day": "max", "recent": "ages", "compliant": "sum",
              "compliant_n": "sum", **{f"{c}{e}": "sum" for c in _MEAL_MEANS for e in ("", "_n")}},
    "weights": {"n": "sum", "days": "set", "last_day": "max", "total": "sum", "total_n": "sum", "largest": "max",
                "smallest": "min", "first": "min", "last": "max"},
    "exercises": {"n": "sum", "days": "set", "types": "set", "last_day": "max", "minutes": "sum", "minutes_n": "sum",
                  "calories": "sum", "steps": "sum"},
    "collections": {"n": "sum", "completed": "sum", "unlocked": "sum", "progress": "sum", "progress_n": "sum",
                    "last_day": "max"},
}
CHANNELS = tuple(_MERGE)


def partial(channel: str, logs: DataFrame, as_of: dt.date) -> DataFrame:
    """The state of a batch of logs, one shuffle by member."""
    def mean(c: Column, name: str) -> list[Column]:
        return [F.sum(c).alias(name), F.count(c).alias(f"{name}_n")]

    first = [F.count(F.lit(1)).alias("n"), F.max("log_date").alias("last_day")]
    days, count_if = F.collect_set("log_date").alias("days"), F.count_if
    if channel == "meals":
        ages = [count_if(days_before(as_of, F.col("log_date")) == d) for d in range(RECENT_DAYS)]
        parts = [days, F.collect_set("meal_type").alias("types"), F.array(*ages).alias("recent"),
                 *mean(F.col("is_compliant").cast("double"), "compliant"),
                 *[a for c in _MEAL_MEANS for a in mean(F.col(c), c)]]
    elif channel == "weights":
        weighed = F.when(F.col("weight_kg").isNotNull() & F.col("log_id").isNotNull(),
                         F.struct("log_date", "log_id", "weight_kg"))
        parts = [days, *mean(F.col("weight_kg"), "total"), F.max("weight_kg").alias("largest"),
                 F.min("weight_kg").alias("smallest"), F.min(weighed).alias("first"), F.max(weighed).alias("last")]
    elif channel == "exercises":
        parts = [days, F.collect_set("exercise_type").alias("types"), *mean(F.col("minutes"), "minutes"),
                 F.sum("calories_burned").alias("calories"), F.sum("steps").alias("steps")]
    elif channel == "collections":
        parts = [count_if("is_completed").alias("completed"), count_if("is_unlocked").alias("unlocked"),
                 *mean(F.col("progress_percent"), "progress")]
    else:
        raise ValueError(f"unknown channel {channel!r}")
    return _until(logs, as_of).groupBy(KEY).agg(*first, *parts).withColumn("as_of", as_of_lit(as_of))


def _aged(as_of: dt.date) -> Column:
    """``recent`` counted from a later day."""
    shift = F.date_diff(as_of_lit(as_of), F.col("as_of"))
    return F.transform(F.sequence(F.lit(0), F.lit(RECENT_DAYS - 1)),
                       lambda d: F.when(d >= shift, F.get("recent", d - shift)).otherwise(F.lit(0)))


def merge(channel: str, states: list[DataFrame], as_of: dt.date) -> DataFrame:
    """Sum of states, as seen on ``as_of`` (none may be later). A member has at most one row in each."""
    rows = states[0]
    for s in states[1:]:
        rows = rows.unionByName(s)
    if channel == "meals":
        rows = rows.withColumn("recent", _aged(as_of))
    out = []
    for c, how in _MERGE[channel].items():
        if how == "set":
            merged = F.array_distinct(F.flatten(F.collect_list(c)))
        elif how == "ages":
            merged = F.array(*[F.sum(F.get(c, F.lit(d))) for d in range(RECENT_DAYS)])
        else:
            merged = getattr(F, how)(c)
        out.append(merged.alias(c))
    return rows.groupBy(KEY).agg(*out).withColumn("as_of", as_of_lit(as_of))


def merge_batch(channel: str, old: DataFrame, batch: DataFrame, members: int, as_of: dt.date) -> DataFrame:
    """``merge`` of a state and a batch of ``members`` rows; what the batch does not touch is not shuffled."""
    if members > BROADCAST_MEMBERS:
        return merge(channel, [old, batch], as_of)
    ids = F.broadcast(batch.select(F.col(KEY).alias("_touched")))
    same = F.col(KEY).eqNullSafe(F.col("_touched"))
    rest = old.join(ids, same, "left_anti")
    if channel == "meals":
        rest = rest.withColumn("recent", _aged(as_of))
    merged = merge(channel, [old.join(ids, same, "left_semi"), batch], as_of)
    return merged.unionByName(rest.withColumn("as_of", as_of_lit(as_of)))


def finish(channel: str, state: DataFrame, as_of: dt.date) -> DataFrame:
    """The channel's feature columns, equal to those of ``features`` over all merged logs."""
    def size(c: str) -> Column:
        return F.size(c).cast("long")

    def mean(c: str, digits: int) -> Column:
        return _rounded_mean(F.col(c), F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_n")), digits)

    n, since = F.col("n"), days_before(as_of, F.col("last_day"))
    if channel == "meals":
        def recent(days: int) -> Column:
            return F.aggregate(F.slice(_aged(as_of), 1, days + 1), F.lit(0).cast("long"), lambda a, x: a + x)
        return state.select(
            KEY, n.alias("total_meal_logs"), size("days").alias("distinct_meal_days"),
            *[mean(c, 1).alias(name) for c, name in _MEAL_MEANS.items()],
            size("types").alias("distinct_meal_types"), mean("compliant", 4).alias("meal_compliance_rate"),
            since.alias("days_since_last_meal"), recent(7).alias("meals_last_7_days"), recent(14).alias("meals_last_14_days"))
    if channel == "weights":
        return state.select(
            KEY, n.alias("total_weight_logs"), size("days").alias("distinct_weight_days"),
            F.round(F.col("largest") - F.col("smallest"), 2).alias("weight_range_kg"),
            F.try_divide("total", "total_n").alias("_avg_weight"), since.alias("days_since_last_weight"),
            F.round(F.col("last.weight_kg") - F.col("first.weight_kg"), 2).alias("weight_change_kg"))
    if channel == "exercises":
        return state.select(
            KEY, n.alias("total_exercise_logs"), size("days").alias("distinct_exercise_days"),
            F.col("minutes").cast("long").alias("total_exercise_minutes"), mean("minutes", 1).alias("avg_exercise_minutes"),
            _rounded_mean(F.col("calories"), F.lit(1), 1).alias("total_calories_burned"),
            F.col("steps").cast("long").alias("total_steps"), since.alias("days_since_last_exercise"),
            size("types").alias("distinct_exercise_types"))
    return state.select(
        KEY, n.alias("total_collection_items"), F.col("completed").alias("completed_items"),
        F.round(safe_rate(F.col("completed"), n), 4).alias("collection_completion_rate"),
        F.round(F.try_divide("progress", "progress_n"), 1).alias("avg_progress_percent"),
        F.col("unlocked").alias("unlocked_items"), since.alias("days_since_last_collection"))


def _folder(root: str, as_of: dt.date) -> str:
    return f"{root.rstrip('/')}/state-{as_of.isoformat()}"


def advance(spark: SparkSession, root: str, batch: ActivityData, before: dt.date | None) -> str:
    """Add a batch to the version of the day ``before`` (None: start) and write the version of ``batch.as_of``."""
    if before is not None and before >= batch.as_of:
        raise ValueError(f"a batch of {batch.as_of} cannot follow the state of {before}")
    for channel in CHANNELS:
        state = partial(channel, getattr(batch, channel), batch.as_of)
        if before is not None:
            state = materialize(state, "state-batch")    # read by its members and by its rows
            state = merge_batch(channel, read(spark, root, channel, before), state, state.count(), batch.as_of)
        state.write.mode("overwrite").parquet(f"{_folder(root, batch.as_of)}/{channel}")
    return _folder(root, batch.as_of)


def read(spark: SparkSession, root: str, channel: str, as_of: dt.date) -> DataFrame:
    path = f"{_folder(root, as_of)}/{channel}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raise FileNotFoundError(f"no complete state {path}; run its batch again")
    return spark.read.parquet(path)


def feature_table(spark: SparkSession, root: str, as_of: dt.date, members: DataFrame, enrollments: DataFrame,
                  with_name: bool = False) -> DataFrame:
    """``features.feature_table`` as of a version's day, without reading any log."""
    parts = [finish(c, read(spark, root, c, as_of), as_of) for c in CHANNELS]
    return features.assemble(members, as_of, [features.enrollment_features(enrollments, as_of), *parts], with_name)
