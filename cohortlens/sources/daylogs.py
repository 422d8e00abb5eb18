"""Activity logs stored in one folder a day, so that a recent window reads only its own days.

Timelines and recent counts look at the last 31 days at most. Stored by day,
their bounds on ``log_date`` select folders (``PartitionFilters`` in the plan)
before any file is opened, and one day's logs can be written again alone.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.activity import ActivityData

CHANNELS = ("meals", "weights", "exercises", "collections")


def write_by_day(data: ActivityData, root: str, files_per_day: int = 1) -> None:
    """All four channels under ``root``. Only the days that ``data`` holds are replaced; a day's rows are dealt
    to ``files_per_day`` tasks by all their columns, so neither a busy day nor a busy member fills one task."""
    for channel in CHANNELS:
        logs: DataFrame = getattr(data, channel)
        others = [c for c in logs.columns if c != "log_date"]
        dealt = logs.repartition("log_date", F.pmod(F.xxhash64(*others), F.lit(files_per_day)))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_date") \
            .parquet(f"{root.rstrip('/')}/{channel}")


def read_by_day(spark: SparkSession, root: str, like: ActivityData, as_of: dt.date | None = None,
                last_days: int | None = None) -> ActivityData:
    """``like`` with its logs read from ``root``; with ``last_days`` only those of as many days up to ``as_of``
    (default: that of ``like``), both ends included. Its columns give the schema, so no folder is listed for it."""
    as_of = as_of or like.as_of
    logs = {}
    for channel in CHANNELS:
        schema = getattr(like, channel).schema
        df = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{channel}").select(*schema.names)
        if last_days is not None:
            df = df.where(F.col("log_date").between(F.lit(as_of - dt.timedelta(days=last_days - 1)), F.lit(as_of)))
        logs[channel] = df
    return dataclasses.replace(like, as_of=as_of, **logs)
