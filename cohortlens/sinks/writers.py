"""Writers for every output of the reference, stored row-wise."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.session import scratch_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Columnar table (default Parquet), optionally partitioned (e.g. by day)."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Feature table as CSV with a header and no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per line (predictions, timelines, metrics).

    The reference writes one JSON array; a line-per-record layout lets every
    task write its own part and every reader split the files. Row order is
    not stored: readers sort by their keys.
    """
    df.write.mode(mode).json(path)


def write_json_map(df: DataFrame, key: str, value: str, path: str,
                   keys_per_object: int = 10000, mode: str = "overwrite") -> None:
    """Id -> value map as JSON objects, one object per line.

    Keys are spread over hash buckets sized for about ``keys_per_object``
    keys each, so no object (and no task) holds the whole map. Read it back
    with ``sources.files.read_json_map(..., wholetext=False)``.
    """
    n = df.count()
    buckets = max(1, -(-n // keys_per_object))
    grouped = (df.select(F.col(key).cast("string").alias("k"), F.col(value).alias("v"))
               .groupBy(F.pmod(F.xxhash64("k"), F.lit(buckets)).alias("_b"))
               .agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m")))
    grouped.select(F.to_json("m").alias("value")).write.mode(mode).text(path)


def write_json_objects(df: DataFrame, key: str, value: str, path: str, objects: int, mode: str = "overwrite") -> None:
    """Id -> value map as ``objects`` files with one pretty-printed JSON object each (an empty table: none).

    The layout of exports that expect one object per file; each file is sorted by key and written by one task,
    row by row. Read it back with ``sources.json_split.read_json_object``.
    """
    pair = F.regexp_replace(F.to_json(F.map_from_arrays(F.array("k"), F.array("v")), {"ignoreNullFields": "false"}),
                            r"^\{|\}$", "")
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(value).alias("v")).where("k IS NOT NULL").select(
        F.pmod(F.xxhash64("k"), F.lit(objects)).cast("int").alias("part"), "k", pair.alias("line"))
    order = Window.partitionBy("part").orderBy("k", "line")
    before = F.when(F.row_number().over(order) == 1, F.lit("{\n  ")).otherwise(F.lit("  "))
    after = F.when(F.lead("k").over(order).isNull(), F.lit("\n}")).otherwise(F.lit(","))
    lines = rows.select("part", "k", F.concat(before, "line", after).alias("value"))
    lines.repartition(objects, "part").sortWithinPartitions("part", "k", "value").select("part", "value") \
        .write.mode(mode).partitionBy("part").text(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metrics, one row per model with ``is_best``."""
    metrics.write.mode(mode).json(path)


def write_feature_columns(spark: SparkSession, feature_cols: list[str], path: str,
                          mode: str = "overwrite") -> DataFrame:
    """Ordered feature list as (position, feature) rows."""
    schema = T.StructType([T.StructField("position", T.IntegerType(), False),
                           T.StructField("feature", T.StringType(), False)])
    df = spark.createDataFrame(list(enumerate(feature_cols)), schema)
    df.write.mode(mode).json(path)
    return df


def write_statistics(spark: SparkSession, statistics: dict[str, float], path: str,
                     mode: str = "overwrite") -> DataFrame:
    """Named training statistics (e.g. channel maxima) as (name, value) rows."""
    df = spark.createDataFrame([(k, float(v)) for k, v in statistics.items()], "name string, value double")
    df.coalesce(1).write.mode(mode).json(path)
    return df


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Assembler (holding the feature order), scaler and classifier together."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
