from conftest import SF001

from cohortlens.operators.models import ModelParams
from cohortlens.plans import workflow
from cohortlens.sources import files
from cohortlens.sources.standin import ORDERS_THRESHOLD_DAYS, events_profile, orders_profile


def test_run_training_writes_every_artifact(spark, tmp_path):
    data = orders_profile(spark, SF001)
    out = workflow.run_training(spark, data, events_profile(spark, SF001), str(tmp_path / "run"),
                                ORDERS_THRESHOLD_DAYS, ModelParams(forest_trees=5, boost_rounds=3),
                                with_cv=False)
    assert spark.read.parquet(out["features"]).count() == 150
    metrics = files.read_metrics(spark, out["metrics"]).collect()
    assert len(metrics) == 3 and sum(r.is_best for r in metrics) == 1
    preds = spark.read.json(out["predictions"])
    assert preds.count() == 150 and "risk_label" in preds.columns
    assert spark.read.json(out["feature_columns"]).count() == 51
    assert spark.read.json(out["timelines"]).count() == spark.read.parquet(
        f"{SF001}/events.parquet").select("user_id").distinct().count()
    from cohortlens import sinks
    model = sinks.load_pipeline(out["model"] + "/pipeline")
    scored = model.transform(spark.read.parquet(out["features"]))
    assert scored.count() == 150 and "probability" in scored.columns
    from cohortlens.operators import serving
    top = serving.published_top(spark, out["search"] + "/ranked", 10).collect()
    assert len(top) == 10
    for row in top[:2]:
        found = serving.published_lookup(spark, out["by_id"], row.member_id).first()
        assert found.churn_probability == row.churn_probability
        hits = serving.published_search(spark, out["search"], row.member_name, 50).collect()
        assert row.member_id in [r.member_id for r in hits]
