import datetime as dt

import pytest

from cohortlens.operators import reports, scoring

SCHEMA = ("member_id long, member_name string, created_at timestamp, churn_probability double, "
          "churn_prediction int, risk_label string")


def preds(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_risk_bucket_uses_unrounded_probability(spark):
    from pyspark.sql import functions as F
    from cohortlens.functions import risk_bucket
    df = spark.createDataFrame([(0.29996,), (0.3,), (0.6,), (float("nan"),)], "p double")
    out = [r.b for r in df.select(risk_bucket(F.col("p")).alias("b")).collect()]
    assert out == ["Low", "Medium", "High", "High"]


def test_search_names_and_literal_wildcards(spark):
    t = dt.datetime(2024, 1, 1)
    df = preds(spark, [(1, "Solo", t, 0.5, 1, "Medium"), (2, "A B C", t, 0.9, 1, "High"),
                       (3, None, t, 0.1, 0, "Low"), (4, "50% off", t, 0.2, 0, "Low")])
    everyone = {r.member_id: r for r in scoring.member_search(df, "", 20).collect()}
    assert (everyone[1].first_name, everyone[1].last_name) == ("Solo", None)
    assert (everyone[2].first_name, everyone[2].last_name) == ("A", "B C")
    assert (everyone[3].first_name, everyone[3].last_name) == ("", "")
    assert [r.member_id for r in scoring.member_search(df, "%", 20).collect()] == [4]
    assert [r.member_id for r in scoring.member_search(df, "", 2).collect()] == [2, 1]
    shown = {r.member_id: r.display_name for r in reports.search_display(scoring.member_search(df, "", 20)).collect()}
    assert shown[3] == "Unnamed Member" and shown[2] == "A B C"


def test_at_risk_counts_cover_limited_rows(spark):
    t = dt.datetime(2024, 1, 1)
    df = preds(spark, [(i, f"n{i}", t, p, 1, lab) for i, (p, lab) in
                       enumerate([(0.9, "High"), (0.8, "High"), (0.5, "Medium"), (0.1, "Low")])])
    s = scoring.at_risk_summary(df, 2).first()
    assert (s.total_members, s.high_risk, s.medium_risk, s.low_risk) == (2, 2, 0, 0)
    assert scoring.risk_summary(df).first().low_risk == 1
    with pytest.raises(ValueError):
        scoring.at_risk_top(df, 10, "Severe")
    with pytest.raises(ValueError):
        scoring.at_risk_top(df, 0)


def test_ties_break_on_created_then_id(spark):
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    df = preds(spark, [(5, "x", a, 0.5, 1, "Medium"), (3, "y", a, 0.5, 1, "Medium"),
                       (9, "z", b, 0.5, 1, "Medium")])
    assert [r.member_id for r in scoring.rank_by_risk(df).collect()] == [9, 3, 5]


def test_gauge_band_differs_from_risk_label_near_edges(spark):
    df = preds(spark, [(1, "a", None, 0.295, 0, "Low"), (2, "b", None, None, 0, "Low")])
    out = {r.member_id: (r.gauge_percent, r.gauge_band) for r in reports.gauge_band(df).collect()}
    assert out[1] == (30, "medium") and out[2] == (0, "low")


def test_key_features_defaults(spark):
    df = spark.createDataFrame([(1, None, 3.0)], "member_id long, total_meal_logs long, engagement_score double")
    row = scoring.key_features(df).first().key_features
    assert row.total_meal_logs == 0 and row.engagement_score == 3.0 and row.days_since_last_meal == 0
    scored = scoring.key_features_scored(df).first().key_features
    assert scored.days_since_last_meal == 9999
