"""Registered queries of this subpackage: name -> (spark, data_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import veccodes
from cohortlens.llm.bitmix import score
from cohortlens.llm.common import attach, table
from cohortlens.llm.divergence import divergence
from cohortlens.llm.host_quality import host_quality
from cohortlens.llm.mixing import label_domains, mix
from cohortlens.llm.ordinal import WANTED, bar, fit_ratings, judge, label_grades
from cohortlens.llm.packing import pack
from cohortlens.llm.pii import BASE_KINDS, find_pii
from cohortlens.llm.projections import nearest
from cohortlens.llm.replytrees import Digest, format_trees, output_folder, read_conversations, reply_chain
from cohortlens.llm.simhash import near_duplicates
from cohortlens.llm.voronoi import top_k
from cohortlens.llm.warc import archive_folder, read_archives, write_archives
from cohortlens.session import materialize


def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules of every document and the verdict of its host."""
    return host_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op2_voronoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op3_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of the wanted grade, and selection of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit_ratings(docs, label_grades(table(spark, sf_dir, "labels")))
    judged = judge(docs.select("doc_id", "text"), model, WANTED)
    return judged.select("doc_id", "expected_grade", "tail_prob", (F.col("tail_prob") >= bar(model)).alias("kept"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    folder = archive_folder(spark)
    rows = read_archives(write_archives(table(spark, sf_dir, "pages"), folder), folder)
    sound = F.when(F.col("problem").isNull(), F.col("page_id")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record: "), F.col("problem"))).cast("long"))
    return rows.select(sound.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_replytrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that quotes control strings, formatted and read back."""
    own = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    folder = output_folder(spark)
    found = read_conversations(format_trees(reply_chain(turns), folder), folder, Digest)
    return found.withColumnRenamed("tree_id", "conv_id").drop("branch")


def vocabulary() -> tuple[str, str, str]:
    """The tokenizer file, the rank file of the same vocabulary, and its split pattern."""
    return (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
            public_tokenizers.PATTERN)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), *vocabulary())


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the personal data in every document."""
    found = find_pii(table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(joined(of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


#: target shares of the emitted tokens by domain
TARGETS = {"clean": 0.96, "poor": 0.03, "toxic": 0.01}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, fitted rate and emitted copies of every document."""
    docs = table(spark, sf_dir, "documents")
    mixed, domains = mix(docs, docs, label_domains(table(spark, sf_dir, "labels")), TARGETS)
    chances = [F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(domains)]
    return mixed.select("doc_id", "tokens", *chances, "rate", "copies")


def op10_bitmix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and context-mixing score of every document."""
    return score(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and each source's own terms."""
    return divergence(table(spark, sf_dir, "documents"))


def op12_veccodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, with the error of its label and the digest of the codebooks."""
    rows = veccodes.integers(table(spark, sf_dir, "embeddings"), F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("label"))
    books = veccodes.fit(rows)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = materialize(veccodes.encode(rows, books), "veccodes-coded")
    by_label = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "veccodes-labels")
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return attach(coded, by_label, "label", by_label.count()).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op13_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_host_quality": op1_host_quality,
    "op2_voronoi": op2_voronoi,
    "op3_ordinal": op3_ordinal,
    "op4_warc": op4_warc,
    "op5_replytrees": op5_replytrees,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_pii": op8_pii,
    "op9_mixing": op9_mixing,
    "op10_bitmix": op10_bitmix,
    "op11_divergence": op11_divergence,
    "op12_veccodes": op12_veccodes,
    "op13_projections": op13_projections,
}
