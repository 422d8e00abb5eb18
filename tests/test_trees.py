import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens import sinks
from cohortlens.operators import evaluate, models, split, trees


def table(spark, n=240, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + x[:, 1] ** 2 + 0.3 * rng.normal(size=n) > 0.6).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "member_id long, a double, b double, c double, is_churned int")


@pytest.fixture(scope="module")
def fitted(spark):
    s = split.stratified_split(table(spark), 0.25)
    params = models.ModelParams(forest_trees=12, boost_rounds=6, partitions=2)
    return s, models.train_and_compare(spark, s, ["a", "b", "c"], 3, params)


@pytest.mark.parametrize("name", ["Random Forest", "Gradient Boosted Trees"])
def test_joins_over_the_node_table_give_the_model_scores(spark, fitted, tmp_path, monkeypatch, name):
    s, result = fitted
    path = str(tmp_path / "m")
    sinks.save_pipeline(result.models[name], path)
    want = {r.member_id: r.score for r in models.with_probability(result.models[name].transform(s)).collect()}
    for limit in (trees.BROADCAST_NODES, 0):
        monkeypatch.setattr(trees, "BROADCAST_NODES", limit)
        got = trees.relational_scores(spark, path, result.models[name], s).collect()
        assert len(got) == len(want) and {r.trees for r in got} == {result.models[name].stages[-1].getNumTrees}
        assert all(abs(r.relational_score - want[r.member_id]) < 1e-12 for r in got)


def test_importances_from_gains(spark, fitted, tmp_path):
    model = fitted[1].models["Random Forest"]
    sinks.save_pipeline(model, str(tmp_path / "m"))
    got = {r.feature: r.importance for r in trees.relational_importances(trees.tree_nodes(spark, str(tmp_path / "m"))).collect()}
    want = model.stages[-1].featureImportances.toArray()
    assert all(abs(got.get(i, 0.0) - v) < 1e-12 for i, v in enumerate(want))


def test_every_training_member_is_scored_once_by_the_fold_that_did_not_see_it(spark, fitted):
    """The out-of-fold table against the folds, and the metrics against SQL over the written tables."""
    s, result = fitted
    folds = {r.member_id: (r.rank_in_label - 1) % 3 for r in s.where(~F.col("is_test")).collect()}
    oof = result.out_of_fold.toPandas()
    held = result.held_out.toPandas()
    for name, mine in oof.groupby("model"):
        assert sorted(mine.member_id) == sorted(folds)
        assert all(folds[m] == f for m, f in zip(mine.member_id, mine.fold))
    con = duckdb.connect()
    want = con.execute("""
        WITH c AS (SELECT model, fold, count(*) FILTER (is_churned = 1 AND prediction = 1) AS tp,
                          count(*) FILTER (is_churned <> prediction) AS wrong FROM oof GROUP BY model, fold),
             f AS (SELECT model, avg(2.0 * tp / (2 * tp + wrong)) AS m, stddev_pop(2.0 * tp / (2 * tp + wrong)) AS sd
                   FROM c GROUP BY model),
             h AS (SELECT model, 2.0 * count(*) FILTER (is_churned = 1 AND prediction = 1)
                          / (2 * count(*) FILTER (is_churned = 1 AND prediction = 1) + count(*) FILTER (is_churned <> prediction)) AS f1
                   FROM held GROUP BY model)
        SELECT model, f1, m, sd FROM f JOIN h USING (model)""").fetchall()
    got = {r.model: (r.f1_score, r.cv_f1_mean, r.cv_f1_std) for r in result.metrics.collect()}
    assert len(want) == 3
    for name, *numbers in want:
        assert got[name] == pytest.approx(tuple(numbers))
    counts = evaluate.part_counts(result.held_out, result.out_of_fold).collect()
    assert len(counts) == 12 and all(r.members == r.distinct_members for r in counts)
    assert sum(r.members for r in counts if r.model == "Random Forest" and r.part != "held out") == len(folds)
    first = max(want, key=lambda r: (r[1], -list(got).index(r[0])))[0]
    assert result.best == first


def test_a_shuffled_model_does_not_beat_the_constant_one(spark, fitted):
    held = fitted[1].held_out.where("model = 'Random Forest'")
    shuffled = held.withColumn("prediction", F.lit(1.0))
    assert not any(r.beats_constant for r in evaluate.part_counts(shuffled, shuffled.withColumn("fold", F.lit(0))).collect())
