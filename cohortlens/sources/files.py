"""Scans: Parquet tables, JDBC queries, CSV feature files, JSON records and
JSON objects keyed by member id, saved metrics. Schemas are always explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder (filters and projections push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, *, table: str | None = None,
              query: str | None = None, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read a relational table or query in parallel slices.

    Credentials come only from ``properties`` supplied by the caller. With a
    partition column, Spark opens ``num_partitions`` connections, each
    reading one key range, instead of one connection pulling everything.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").option("url", url)
    reader = reader.option("dbtable", table) if table is not None else reader.option("query", query)
    if partition_column is not None:
        if table is None:
            raise ValueError("partitioned reads need a table, not a query")
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned reads need lower_bound, upper_bound, num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every NaN of a float or double column as NULL; other columns as they are."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Feature CSV with a header; the schema is given, never inferred. NaN reads as NULL."""
    return nan_to_null(spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path))


def read_json_records(spark: SparkSession, path: str, schema: T.StructType,
                      multiline: bool = False) -> DataFrame:
    """JSON records (one per line, or one JSON array per file with ``multiline``)."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_json_map(spark: SparkSession, path: str, value_type: str = "string",
                  key_name: str = "member_id", value_name: str = "value",
                  wholetext: bool = True) -> DataFrame:
    """JSON objects ``{id: value, ...}`` as a two-column table.

    ``read.json`` would turn every key into a column; parsing the text as a
    map and exploding it gives one row per key. With ``wholetext`` each file
    is one (possibly pretty-printed) object and one row of one task: only for
    importing old exports, never for data of our own. Without it each line is
    one object, as ``sinks.write_json_map`` writes.
    """
    text = spark.read.text(path, wholetext=wholetext)
    parsed = text.select(F.from_json("value", f"map<string,{value_type}>").alias("m"))
    return parsed.select(F.explode("m").alias(key_name, value_name))


def read_statistics(spark: SparkSession, path: str) -> dict[str, float]:
    """Named training statistics (see ``sinks.write_statistics``): a few numbers."""
    return {r["name"]: r["value"] for r in spark.read.schema("name string, value double").json(path).collect()}


METRICS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("model_order", T.IntegerType(), False),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("cv_f1_mean", T.DoubleType()),
    T.StructField("cv_f1_std", T.DoubleType()),
    T.StructField("is_best", T.BooleanType()),
])


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Saved model metrics, one row per model (see ``sinks.write_metrics``)."""
    return spark.read.schema(METRICS_SCHEMA).json(path)
