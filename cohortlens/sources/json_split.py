"""Large JSON objects ``{id: value, ...}`` read in several tasks.

The text reader splits a file by byte ranges at any line separator, here the
comma, so an object on one line or pretty-printed comes as fragments from many
tasks. Whether a comma parts two top-level entries depends on all text before
it, namely on open strings and brackets. Both are running sums: over fragments
inside a block (a byte range, at most ``spark.sql.files.maxPartitionBytes``),
and over one summary row a block. A summary holds the bracket sums for either
state of the string at the block's start, so one pass over the text is enough
to make it. Fragments of one entry are then joined, and each entry is parsed.

One object per file, in UTF-8. Broken files are an error, not fewer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _less(text: Column, chars: str) -> Column:
    """How often ``chars`` occur."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, text, quotes, deeper_0, deeper_1): fragments in order, their unescaped quotes, and
    the brackets they open less those they close when they start outside (0) or inside (1) a string."""
    raw = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    plain = F.regexp_replace("text", r"(?s)\\.", "")    # a pair of escape and character never spans a comma

    def deeper(t: Column) -> Column:
        outside = F.regexp_replace(t, r'"[^"]*("|\z)', "")
        return (_less(outside, "{[") - _less(outside, "}]")).cast("long")

    order = Window.partitionBy("file", "block").orderBy("id")
    return raw.select(
        "file", "block", F.row_number().over(order).alias("at"), "text", _less(plain, '"').cast("long").alias("quotes"),
        deeper(plain).alias("deeper_0"), deeper(F.concat(F.lit('"'), plain)).alias("deeper_1"))


def _before(c: Column, w) -> Column:
    return F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, last, text): top-level entries, and whether the object opens and closes in them."""
    inside = Window.partitionBy("file", "block").orderBy("at")
    run = _fragments(spark, path).withColumn("odd", _before(F.col("quotes"), inside) % 2)
    # bracket change if the block starts outside or inside a string
    run = run.select("file", "block", "at", "text", "quotes", "odd", *[
        F.when(F.col("odd") == s, F.col("deeper_0")).otherwise(F.col("deeper_1")).alias(f"step_{s}") for s in (0, 1)])
    along = Window.partitionBy("file").orderBy("block")     # one row a block
    blocks = run.groupBy("file", "block").agg(*[F.sum(c).alias(c) for c in ("quotes", "step_0", "step_1")]) \
        .withColumn("string_at_start", _before(F.col("quotes"), along) % 2) \
        .withColumn("step", F.when(F.col("string_at_start") == 0, F.col("step_0")).otherwise(F.col("step_1"))) \
        .withColumns({"depth_at_start": _before(F.col("step"), along), "depth_at_end": F.sum("step").over(Window.partitionBy("file")),
                      "quotes_at_end": F.sum("quotes").over(Window.partitionBy("file")) % 2})
    whole = F.when((F.col("depth_at_end") != 0) | (F.col("quotes_at_end") != 0), F.raise_error(
        F.concat(F.lit("brackets or quotes left open in "), F.col("file"))).cast("long")).otherwise(F.col("depth_at_start"))
    known = run.join(blocks.select("file", "block", "string_at_start", whole.alias("depth_at_start")), ["file", "block"])
    step = F.when(F.col("string_at_start") == 0, F.col("step_0")).otherwise(F.col("step_1"))
    depth = F.col("depth_at_start") + _before(step, inside)
    opens = ((F.col("odd") + F.col("string_at_start")) % 2 == 0) & (depth <= 1)
    marked = known.select("file", "block", "at", "text", (depth + step == 0).alias("ends"), (depth == 0).alias("begins"),
                          F.when(opens, F.struct("block", "at")).alias("start"))
    # the entry of a fragment starts at the latest start up to it, in its block or in an earlier one
    carried = marked.groupBy("file", "block").agg(F.max("start").alias("start")).select(
        "file", "block", F.max("start").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    latest = F.max("start").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    owned = marked.join(carried, ["file", "block"]).select(
        "file", "block", "at", "text", "begins", "ends", F.coalesce(latest, F.col("earlier")).alias("entry"))
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "text")))
    return owned.groupBy("file", "entry").agg(F.bool_or("begins").alias("first"), F.bool_or("ends").alias("last"), parts.alias("p")) \
        .select("file", "first", "last", F.concat_ws(",", F.col("p.text")).alias("text"))


def read_json_object(spark: SparkSession, path: str, value_type: str = "string", key_name: str = "member_id",
                     value_name: str = "value") -> DataFrame:
    """Entries of JSON objects, one object a file, as ``files.read_json_map`` gives them."""
    e = _entries(spark, path)
    body = F.when(F.col("first"), F.regexp_replace("text", r"^\s*\{", "")).otherwise(F.col("text"))
    body = F.when(F.col("last"), F.regexp_replace(body, r"\}\s*$", "")).otherwise(body)
    parsed = F.from_json(F.concat(F.lit("{"), body, F.lit("}")), f"map<string,{value_type}>", {"mode": "FAILFAST"})
    return e.select(F.explode(parsed).alias(key_name, value_name))
