import random

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import ordinal as o
from helpers import clash, documents


def test_features_are_distinct_and_cover_the_text():
    doc, bucket = o.features(pa.array(["One one TWO!! two", None, "", "x\nx\nx\ny", "### 12 é"]))
    assert len(set(zip(doc.tolist(), bucket.tolist()))) == len(doc)
    assert (doc == 1).sum() == (doc == 2).sum() == 1
    assert o._bucket("word", b"one") in bucket[doc == 0] and o._bucket("shape0", b"A!") in bucket[doc == 0]
    assert o._bucket("lines2", b"") in bucket[doc == 3] and o._bucket("shape0", b"a") in bucket[doc == 4]
    assert o.shape("ABc12..é") == "Aa0.a"


def test_gradient_and_ordered_thresholds():
    """The fit climbs the likelihood and keeps the thresholds ordered; chances sum to one."""
    rng = np.random.default_rng(0)
    y, rows = [], []
    for i in range(600):
        good, bad = rng.random() < 0.5, rng.random() < 0.3
        y.append(2 if good and not bad else 1 if good else 0)
        rows.append([1] * good + [2] * bad + [10 + int(rng.integers(50))])
    starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    model = o.fit(starts, np.concatenate(rows), np.array(y))
    assert (np.diff(model.thresholds) > 0).all() and model.grades.tolist() == [0, 1, 2]
    s = np.array([sum(model.weights[model.buckets == b].sum() for b in r) for r in rows])
    p = model.chances(s)
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert (p.argmax(1) == np.array(y)).mean() > 0.85


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    ratings = o.label_grades(labels)
    known = ratings.filter("doc_id % 3 <> 0")
    model = o.fit_ratings(docs, known)
    test = docs.join(ratings.filter("doc_id % 3 = 0"), "doc_id")
    rows = o.judge(test, model, o.WANTED).select("grade", "tail_prob", "expected_grade").collect()
    kept = {g: np.mean([r.tail_prob >= o.bar(model) for r in rows if r.grade == g]) for g in (0, 1, 2)}
    print(kept)
    assert kept[2] > 0.95 and kept[0] < 0.05 and kept[1] < 0.25
    mean = {g: np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)}
    assert mean[0] < mean[1] < mean[2]


def test_a_model_that_knows_nothing_keeps_all():
    model = o.fit(np.array([0, 1, 2, 3, 4]), np.array([1, 2, 3, 4]), np.array([0, 2, 2, 2]))
    assert not len(model.weights) and model.chances(np.zeros(1))[0, 1] >= o.bar(model)


def test_edge_cases(spark):
    texts = [None, "", "good text here", "good text here", "BAD!! BAD!!"]
    docs = clash(documents(spark, texts, ids=[None, 1, 2, 2, 3]), "grade", "tail_prob")
    ratings = spark.createDataFrame([(2, 1), (3, 0), (None, 1), (1, None), (2, 1)], "doc_id long, grade long")
    model = o.fit_ratings(docs, ratings)
    out = o.judge(docs, model, 1)
    assert out.count() == 5 and out.columns == [c for c in docs.columns if c != "tail_prob"] + ["expected_grade", "tail_prob"]
    nothing = o.fit_ratings(docs, ratings.limit(0))
    assert [(r.expected_grade, r.tail_prob) for r in o.judge(docs, nothing, 1).collect()] == [(0.0, 1.0)] * 5
    one = o.fit_ratings(docs, ratings.filter("grade = 1"))
    assert [(r.expected_grade, r.tail_prob) for r in o.judge(docs, one, 1).collect()] == [(1.0, 1.0)] * 5
    assert o.judge(documents(spark, []), model, 1).count() == 0
    assert model.thresholds == pytest.approx(sorted(model.thresholds))


def test_repeated_rated_rows_are_fitted_once(spark, monkeypatch):
    texts = [f"good line {i}" if i % 2 else f"bad stuff {i}" for i in range(20)]
    docs = documents(spark, texts + [texts[3]] * 500 + ["other text", None], ids=[*range(20), *[3] * 500, 3, 4])
    ratings = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, grade long")
    seen = []
    monkeypatch.setattr(o, "fit", lambda starts, buckets, grades: seen.append((len(starts) - 1, list(grades))))
    o.fit_ratings(docs, ratings)
    assert seen == [(20, [i % 2 for i in range(20)])]
