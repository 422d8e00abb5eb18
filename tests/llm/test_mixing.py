import random

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import mixing
from helpers import clash, documents


def tables(spark, n=300, seed=2):
    rng = random.Random(seed)
    vocab = {"a": ["sun", "moon", "star"], "b": ["fish", "crab", "eel"]}
    texts, domains = [], []
    for i in range(n):
        d = "a" if rng.random() < 0.8 else "b"
        words = [rng.choice(vocab[d]) if rng.random() < 0.5 else f"w{rng.randrange(30)}" for _ in range(rng.randint(20, 80))]
        texts.append(" ".join(words))
        domains.append(d)
    docs = documents(spark, texts)
    labelled = spark.createDataFrame([(i, d) for i, d in enumerate(domains) if i % 2], "doc_id long, domain string")
    return docs, labelled, domains


def test_posteriors_and_targets(spark):
    docs, labelled, domains = tables(spark)
    mixed, names = mixing.mix(clash(docs, "tokens", "p", "rate"), docs, labelled, {"a": 0.5, "b": 0.5})
    rows = {r.doc_id: r for r in mixed.collect()}
    assert names == ["a", "b"] and len(rows) == len(domains)
    right = sum((rows[i].p[0] > 0.5) == (d == "a") for i, d in enumerate(domains))
    assert right >= 0.98 * len(domains)
    assert all(abs(sum(r.p) - 1) < 1e-9 and 0 <= r.rate <= 1 and r.copies in (0, 1) for r in rows.values())
    assert all(rows[i].copies == 1 for i, d in enumerate(domains) if d == "b")  # the scarce domain stays whole
    got = mixing.weights_of(mixed, names)
    assert got["b"] == pytest.approx(0.5, abs=0.03)


def test_rates_equal_plain_projected_gradient(spark):
    rng = random.Random(5)
    soft = [(i, rng.randint(1, 50), p) for i in range(80) for p in [rng.random()]]
    df = spark.createDataFrame([(i, t, [p, 1 - p]) for i, t, p in soft], "doc_id long, tokens long, p array<double>")
    for max_rate, targets in ((1.0, {"x": 0.9, "y": 0.1}), (5.0, {"x": 0.3, "y": 0.7}), (1.0, {"x": 1.0})):
        history = mixing.fit_rates(df, ["x", "y"], targets, 900.0, max_rate, rounds=25)
        got = {r.doc_id: r.r for r in df.select("doc_id", mixing._rate(F.col("p"), history, max_rate).alias("r")).collect()}
        rate = {i: 1.0 for i, _, _ in soft}
        mass = [sum(t * p for _, t, p in soft), sum(t * (1 - p) for _, t, p in soft)]
        want = [900.0 * targets.get(k, 0) / sum(targets.values()) for k in "xy"]
        for _ in history:
            s = [sum(rate[i] * t * p for i, t, p in soft), sum(rate[i] * t * (1 - p) for i, t, p in soft)]
            g = [(a - b) / m for a, b, m in zip(s, want, mass)]
            rate = {i: min(max_rate, max(0.0, rate[i] - g[0] * p - g[1] * (1 - p))) for i, t, p in soft}
        assert all(got[i] == pytest.approx(rate[i], abs=1e-9) for i in rate)


def test_written_rates_change_nothing(spark, monkeypatch):
    rng = random.Random(6)
    df = spark.createDataFrame([(i, rng.randint(1, 50), [p, 1 - p]) for i in range(60) for p in [rng.random()]],
                               "doc_id long, tokens long, p array<double>")
    monkeypatch.setattr(mixing, "CLOSE", 0.0)
    runs = []
    for every in (100, 10, 1):
        monkeypatch.setattr(mixing, "WRITE_EVERY", every)
        runs.append(mixing.fit_rates(df, ["x", "y"], {"x": 0.8, "y": 0.2}, 700.0, 1.0, rounds=23))
    assert len(runs[0]) == 23
    for other in runs[1:]:
        assert all(a == pytest.approx(b, abs=1e-12) for x, y in zip(runs[0], other) for a, b in zip(x, y))


def test_reaches_targets_when_rates_may_rise(spark):
    docs, labelled, _ = tables(spark, 200, 9)
    mixed, names = mixing.mix(docs, docs, labelled, {"a": 1, "b": 3}, budget=9000.0, max_rate=50.0)
    assert mixing.weights_of(mixed, names)["b"] == pytest.approx(0.75, abs=0.02)
    out = mixing.emit(docs, mixed)
    assert out.columns == docs.columns and out.count() == mixed.agg(F.sum("copies")).first()[0]


def test_a_vanishing_domain_does_not_empty_the_corpus(spark):
    docs, labelled, domains = tables(spark)
    main = documents(spark, [r.text for r in docs.orderBy("doc_id").collect() if domains[r.doc_id] == "a"])
    mixed, names = mixing.mix(main, docs, labelled, {"a": 0.9, "b": 0.1})
    assert mixed.filter("copies = 1").count() >= 0.99 * main.count()


def test_edge_cases(spark):
    docs = documents(spark, [None, "", "sun", "sun", "eel eel", " "], ids=[None, 1, 2, 2, 3, 4])
    labelled = spark.createDataFrame([(2, "a"), (3, "b"), (None, "a"), (4, None), (2, "a")], "doc_id long, domain string")
    mixed, names = mixing.mix(docs, docs, labelled, {"a": 0.5, "b": 0.5})
    rows = {r.doc_id: r for r in mixed.collect()}
    assert set(rows) == {None, 1, 2, 3, 4} and names == ["a", "b"]
    assert [rows[i].tokens for i in (None, 1, 2, 3, 4)] == [0, 0, 2, 2, 0]
    assert mixing.emit(docs, mixed).count() == sum(rows[i].copies for i in (None, 1, 2, 2, 3, 4))
    none = spark.createDataFrame([], "doc_id long, domain string")
    plain, names = mixing.mix(docs, docs, none, {"a": 1.0})
    assert names == [] and plain.count() == 5 and mixing.emit(docs, plain).count() == 6
    empty = documents(spark, [])
    assert mixing.mix(empty, docs, labelled, {"a": 1.0})[0].count() == 0


def test_plan_has_no_python(spark):
    docs, labelled, _ = tables(spark, 40)
    mixed, _ = mixing.mix(docs, docs, labelled, {"a": 1, "b": 1})
    plan = mixing.emit(docs, mixed)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "MapIn"))
