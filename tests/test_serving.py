"""Published predictions answer as the whole table does, from few folders."""

import datetime as dt

import pytest

from cohortlens import sinks
from cohortlens.operators import scoring, serving

SCHEMA = ("member_id long, member_name string, created_at timestamp, churn_probability double, "
          "churn_prediction int, risk_label string")
NAMES = ("Ringo Star", "ana", None, "", "O'Brien  Li", "50% off", "ÄRGER Öl", "spring RING", "a_b_c", "ab")


@pytest.fixture(scope="module")
def predictions(spark):
    rows = []
    for i in range(400):
        p = round((i * 37 % 100) / 100, 4)
        label = "High" if p >= 0.6 else "Medium" if p >= 0.3 else "Low"
        created = None if i % 11 == 0 else dt.datetime(2024, 1, 1 + i % 20)
        rows.append((i, NAMES[i % len(NAMES)], created, p, int(p >= 0.4), label))
    return spark.createDataFrame(rows, SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_reads_one_folder(spark, predictions):
    folder = sinks.scratch_path(spark, "by-id")
    serving.publish_by_id(predictions, folder, rows_per_part=50)
    for member in (0, 42, 399, 400, -1):
        got = serving.published_lookup(spark, folder, member)
        assert got.columns == predictions.columns
        assert got.collect() == scoring.prediction_lookup(predictions, member).collect()
    assert "PartitionFilters: [isnotnull(id_part" in plan(serving.published_lookup(spark, folder, 42))


def test_top_lists_and_summary(spark, predictions):
    folder = sinks.scratch_path(spark, "by-rank")
    serving.publish_by_rank(predictions, folder, rows_per_part=30)
    for limit in (1, 29, 100, 500):
        for label in (None, "High", "Medium", "Low"):
            got = serving.published_top(spark, folder, limit, label)
            assert got.collect() == scoring.at_risk_top(predictions, limit, label).collect(), (limit, label)
    assert "PartitionFilters: [isnotnull(rank_part" in plan(serving.published_top(spark, folder, 5))
    assert serving.published_summary(spark, folder).collect() == scoring.risk_summary(predictions).collect()
    with pytest.raises(ValueError):
        serving.published_top(spark, folder, 5, "Severe")
    with pytest.raises(ValueError):
        serving.published_top(spark, folder, 0)


def test_search_equals_the_scan(spark, predictions):
    folder = sinks.scratch_path(spark, "search")
    serving.publish_search(predictions, folder, postings_per_part=200)
    for needle in ("", "r", "ri", "ring", "RING", "spring ring", "zzz", "ringx", "%", "50%", "a_b", "ärg", " li",
                   "  l", "39", "399", "o'b", "a.a"):
        for limit in (1, 7, 50):
            got = serving.published_search(spark, folder, needle, limit).collect()
            assert got == scoring.member_search(predictions, needle, limit).collect(), (needle, limit)
    assert "PartitionFilters: [isnotnull(gram_part" in plan(serving.published_search(spark, folder, "ring"))
    with pytest.raises(ValueError):
        serving.published_search(spark, folder, "ring", 0)


def test_a_frequent_piece_spans_folders(spark):
    """A third of all postings under one piece is spread, and still all of it is searched."""
    rows = [(i, "mmm" if i % 2 else f"n{i:05d}", None, 0.5, 1, "Medium") for i in range(600)]
    folder = sinks.scratch_path(spark, "search-hot")
    serving.publish_search(spark.createDataFrame(rows, SCHEMA), folder, postings_per_part=100)
    hot = spark.read.parquet(f"{folder}/grams").where("gram = 'mmm'").first()
    assert hot.members == 300 and hot.last_part - hot.first_part >= 2
    assert [r.member_id for r in serving.published_search(spark, folder, "mmm", 50).collect()] == list(range(1, 100, 2))


def test_empty_table(spark, predictions):
    none = predictions.limit(0)
    a, b, c = (sinks.scratch_path(spark, n) for n in "abc")
    serving.publish_by_id(none, a)
    serving.publish_by_rank(none, b)
    serving.publish_search(none, c)
    assert serving.published_lookup(spark, a, 1).collect() == []
    assert serving.published_top(spark, b).collect() == []
    assert serving.published_summary(spark, b).first().total_members == 0
    assert serving.published_search(spark, c, "ring").collect() == []
