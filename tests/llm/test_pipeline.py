"""The pipeline's stages one by one against plain versions on a small table."""

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm import mixing, ordinal, pii, simhash
from helpers import clash, documents
from test_packing import check
from test_pii import brute as brute_spans
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "PII", "mixing sources to target weights", "packing"]

    # 1: the same fit and decision, made here
    before = rows_of(docs)
    grades = {r.doc_id: 0 if not r.quality else 1 if r.toxic else 2
              for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rated = sorted(d for d in grades if d in before)
    doc, bucket = ordinal.features(pa.array([before[d].text for d in rated]))
    model = ordinal.fit(np.searchsorted(doc, np.arange(len(rated) + 1)), bucket, np.array([grades[d] for d in rated]))
    ids = sorted(before)
    tail = model.chances(ordinal._scores(pa.array([before[d].text for d in ids]), model.dense()))[:, 2]
    want = {d for d, t in zip(ids, tail) if t >= ordinal.bar(model)}
    kept = stages["quality classifier"](spark, docs, SF)
    assert kept.columns == columns and set(rows_of(kept)) == want
    assert kept.count() == len(want)

    # 2: components of brute-force fingerprints
    first = rows_of(kept)
    groups = brute_components([(d, brute_fingerprint(r.text)) for d, r in first.items()])
    unique = stages["SimHash near-dedup"](spark, kept, SF)
    second = rows_of(unique)
    assert unique.columns == columns and set(second) == {d for d, c in groups.items() if d == c}

    # 3: the base patterns are gone, everything else is as it was
    masked = stages["PII"](spark, unique, SF)
    third = rows_of(masked)
    assert masked.columns == columns and set(third) == set(second)
    for d, r in third.items():
        spans = pii.find_spans(second[d].text)
        assert set(brute_spans(second[d].text)) <= set(spans)
        assert r.text == pii.mask(second[d].text, spans) and r.n_chars == len(r.text)
        if not spans:
            assert r == second[d]

    # 4: decisions are whole rows; nothing clean is lost
    mixed = stages["mixing sources to target weights"](spark, masked, SF)
    fourth = rows_of(mixed)
    assert mixed.columns == columns and set(fourth) <= set(third) and all(fourth[d] == third[d] for d in fourth)
    clean = [d for d in third if grades.get(d) == 2]
    assert sum(d in fourth for d in clean) >= 0.98 * len(clean)

    # 5: every id of every document exactly once
    pieces = stages["packing"](spark, mixed, SF).collect()
    assert check(pieces, {d: r.text for d, r in fourth.items()}, 1024) < 0.1


def test_run_and_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = docs.sparkSession.createDataFrame(
        [(None, None, None, None, None), (10_001, "", "en", "s", 0), (10_002, None, "en", None, None),
         (10_003, "mail a.b@c.example.org " + "word " * 30, "en", "s", 1)] * 2, docs.schema)
    clash(docs.union(odd), "tail_prob", "fp", "rate").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 0 and out.filter("doc_id = 10003").count() <= 1
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(tmp_path / "none" / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_mixing_reaches_its_targets_behind_the_filter(spark, tmp_path):
    """Input like that of the stage: clean but for a few toxic documents, more than their target share."""
    rng = np.random.default_rng(4)

    def text(*own):
        return " ".join(rng.choice([*own, *(f"w{k}" for k in range(30))], 40, p=[0.1] * 5 + [0.5 / 30] * 30))

    toxic = [i % 4 == 0 for i in range(400)]
    texts = [text("foul", "vile", "rude", "mean", "grim") if t else text("sun", "moon", "star", "sky", "sea") for t in toxic]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(t)) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    clean = [t for t, bad in zip(texts, toxic) if not bad] * 12
    docs = documents(spark, clean + [t for t, bad in zip(texts, toxic) if bad][:20])  # a share of 0.0055
    mixed, domains = corpus_pipeline.mixing_rates(spark, docs, str(tmp_path))
    got = mixing.weights_of(mixed, domains)
    for domain, share in corpus_pipeline.FILTERED_TARGETS.items():
        assert abs(got[domain] - share) < 2e-4
    kept = {r.doc_id for r in corpus_pipeline.mixing(spark, docs, str(tmp_path)).collect()}
    assert len([d for d in kept if d < len(clean)]) >= 0.999 * len(clean)
    assert len([d for d in kept if d >= len(clean)]) < 12
    # other targets on unfiltered input: the share of toxic tokens falls from a quarter to the target
    raw = documents(spark, texts)
    before = mixing.weights_of(mixed_as_given(spark, raw, tmp_path), domains)["toxic"]
    mixed, domains = corpus_pipeline.mixing_rates(spark, raw, str(tmp_path), {"clean": 0.97, "toxic": 0.03})
    assert before > 0.24 and abs(mixing.weights_of(mixed, domains)["toxic"] - 0.03) < 2e-3
    out = corpus_pipeline.mixing(spark, raw, str(tmp_path), {"clean": 0.97, "toxic": 0.03})
    left = [r.doc_id for r in out.collect()]
    assert sum(not toxic[d] for d in left) == 300 and 3 <= sum(toxic[d] for d in left) <= 17


def mixed_as_given(spark, docs, folder):
    """The documents' posteriors at rate 1."""
    labels = mixing.label_domains(spark.read.parquet(str(folder / "labels.parquet")))
    model = mixing.fit_domains(docs, labels)
    return mixing.posteriors(docs, model).withColumn("rate", F.lit(1.0))
