"""Published predictions: layouts of which a request reads a small part.

A lookup, a top list or a search over a lazy prediction table aggregates all
logs again. Here the predictions are written once per scoring run, in three
layouts, and every request prunes folders by their partition column:

* by id: folders by hash of ``member_id``; a lookup reads one;
* by rank: folders are ranges of the risk order, with the members per risk
  band of each; a top list reads the first that hold enough;
* by trigram: one posting per three-letter piece of the lower-cased id and name
  and member, in ranges of (piece, member), so that a frequent piece spans
  several folders; a search reads the postings of the needle's rarest piece.

Results are those of ``scoring`` on the whole table. A posting repeats the
shown columns, so a search needs no join; that costs about as many small rows
as names have letters.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import constants as K
from cohortlens.operators import scoring
from cohortlens.sinks.writers import write_table

ROWS_PER_PART = 1_000_000
POSTINGS_PER_PART = 8_000_000
GRAM = 3
_SHOWN = ("member_id", "member_name", "created_at", "churn_probability")


def _parts_of(rows: int, per_part: int) -> int:
    return max(1, -(-rows // per_part))


def _write_meta(spark: SparkSession, folder: str, schema: T.StructType, parts: int) -> None:
    """Number of folders and columns of a layout (an empty table has no file that says them)."""
    write_table(spark.createDataFrame([(parts, schema.json())], "parts int, columns string").coalesce(1),
                f"{folder}/layout")


def _open(spark: SparkSession, folder: str, part: str) -> tuple[DataFrame, int]:
    meta = spark.read.parquet(f"{folder}/layout").first()
    columns = T.StructType.fromJson(json.loads(meta["columns"]))
    return spark.read.schema(columns.add(part, T.IntegerType())).parquet(f"{folder}/rows"), meta["parts"]


# --- by id ------------------------------------------------------------------------

def _id_part(member_id: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(member_id), F.lit(parts)).cast("int")


def publish_by_id(predictions: DataFrame, folder: str, rows_per_part: int = ROWS_PER_PART) -> None:
    """Predictions in folders by hash of the id, sorted by id within."""
    parts = _parts_of(predictions.count(), rows_per_part)
    rows = predictions.withColumn("id_part", _id_part(F.col("member_id"), parts))
    write_table(rows.repartition(parts, "id_part").sortWithinPartitions("id_part", "member_id"),
                f"{folder}/rows", partition_by=["id_part"])
    _write_meta(predictions.sparkSession, folder, predictions.schema, parts)


def published_lookup(spark: SparkSession, folder: str, member_id) -> DataFrame:
    """The prediction of one member from its folder (zero rows means "not found")."""
    rows, parts = _open(spark, folder, "id_part")
    wanted = F.lit(member_id).cast(rows.schema["member_id"].dataType)
    return scoring.prediction_lookup(rows.where(F.col("id_part") == _id_part(wanted, parts)), member_id).drop("id_part")


# --- by rank ----------------------------------------------------------------------

def publish_by_rank(predictions: DataFrame, folder: str, rows_per_part: int = ROWS_PER_PART) -> None:
    """Predictions in folders that are ranges of the risk order, and the members per folder and band.

    The order ends with the id, so equal probabilities split over folders too.
    """
    spark = predictions.sparkSession
    parts = _parts_of(predictions.count(), rows_per_part)
    rows = predictions.repartitionByRange(parts, *scoring.rank_order()).withColumn("rank_part", F.spark_partition_id())
    write_table(rows.sortWithinPartitions("rank_part", *scoring.rank_order()), f"{folder}/rows",
                partition_by=["rank_part"])
    _write_meta(spark, folder, predictions.schema, parts)
    written, _ = _open(spark, folder, "rank_part")
    bands = written.groupBy("rank_part", "risk_label").agg(F.count(F.lit(1)).alias("members"))
    write_table(bands.coalesce(1), f"{folder}/bands")


def published_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """The whole published table."""
    return _open(spark, folder, "rank_part")[0].drop("rank_part")


def published_top(spark: SparkSession, folder: str, limit: int = K.AT_RISK_DEFAULT_LIMIT,
                  label: str | None = None) -> DataFrame:
    """``scoring.at_risk_top`` from the first folders that hold ``limit`` members (of the band).

    The driver reads the band counts only: at most three rows a folder.
    """
    rows, parts = _open(spark, folder, "rank_part")
    bands = scoring.risk_filter(spark.read.parquet(f"{folder}/bands"), label)
    counts = bands.groupBy("rank_part").agg(F.sum("members").alias("members")).orderBy("rank_part").collect()
    held, last = 0, 0
    for r in counts:
        if held >= limit:
            break
        held, last = held + r["members"], r["rank_part"]
    return scoring.at_risk_top(rows.where(F.col("rank_part") <= last), limit, label)


def published_summary(spark: SparkSession, folder: str) -> DataFrame:
    """``scoring.risk_summary`` from the band counts alone."""
    bands = spark.read.parquet(f"{folder}/bands")

    def members(label: str | None) -> Column:
        n = F.col("members") if label is None else F.when(F.col("risk_label") == label, F.col("members"))
        return F.coalesce(F.sum(n), F.lit(0))

    return bands.agg(members(None).alias("total_members"), members("High").alias("high_risk"),
                     members("Medium").alias("medium_risk"), members("Low").alias("low_risk"))


# --- by trigram -------------------------------------------------------------------

def _grams(text: Column) -> Column:
    last = F.greatest(F.length(text) - (GRAM - 1), F.lit(1))
    pieces = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.filter(pieces, lambda p: F.length(p) == GRAM)


def publish_search(predictions: DataFrame, folder: str, postings_per_part: int = POSTINGS_PER_PART,
                   rows_per_part: int = ROWS_PER_PART) -> None:
    """Postings of every piece of id and name, in ranges of (piece, member), with each piece's
    count and folders; and the ranked table for needles shorter than a piece."""
    spark = predictions.sparkSession
    shown = predictions.select(*_SHOWN)
    both = F.array_distinct(F.concat(_grams(F.lower(F.col("member_id").cast("string"))),
                                     _grams(F.lower(F.coalesce("member_name", F.lit(""))))))
    postings = shown.select(F.explode(both).alias("gram"), *_SHOWN)
    parts = _parts_of(postings.count(), postings_per_part)
    ranged = postings.repartitionByRange(parts, "gram", "member_id").withColumn("gram_part", F.spark_partition_id())
    write_table(ranged.sortWithinPartitions("gram_part", "gram", "member_id"), f"{folder}/rows",
                partition_by=["gram_part"])
    _write_meta(spark, folder, postings.schema, parts)
    written, _ = _open(spark, folder, "gram_part")
    grams = written.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.min("gram_part").alias("first_part"),
                                        F.max("gram_part").alias("last_part"))
    write_table(grams.repartitionByRange(parts, "gram").sortWithinPartitions("gram"), f"{folder}/grams")
    publish_by_rank(predictions, f"{folder}/ranked", rows_per_part)


def published_search(spark: SparkSession, folder: str, q: str = "", limit: int = K.SEARCH_DEFAULT_LIMIT) -> DataFrame:
    """``scoring.member_search`` over the postings of the needle's rarest piece.

    A needle shorter than a piece is looked for in the whole published table.
    A needle with a piece that no member has finds nothing.
    """
    needle = q.lower()
    wanted = sorted({needle[i:i + GRAM] for i in range(len(needle) - GRAM + 1)})
    if not wanted:
        return scoring.member_search(published_ranked(spark, f"{folder}/ranked"), q, limit)
    grams = spark.read.parquet(f"{folder}/grams").where(F.col("gram").isin(wanted)).collect()  # one row a piece
    postings, _ = _open(spark, folder, "gram_part")
    if len(grams) < len(wanted):
        return scoring.member_search(postings.where(F.lit(False)), q, limit)
    rarest = min(grams, key=lambda r: (r["members"], r["gram"]))
    listed = postings.where(F.col("gram_part").between(rarest["first_part"], rarest["last_part"])
                            & (F.col("gram") == rarest["gram"]))
    return scoring.member_search(listed, q, limit)
