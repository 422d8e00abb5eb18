"""Second-order boosting against a plain numpy version, and its edge cases."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cohortlens.operators import boosting, trees
from cohortlens.operators.boosting import BoostParams

COLS = ["a", "b", "c", "d"]
SCHEMA = "member_id long, a double, b double, c double, d double, is_churned int, w double"


def rows(n=300, seed=5, missing=True):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = (x[:, 0] + x[:, 1] ** 2 + 0.4 * rng.normal(size=n) > 0.7).astype(int)
    if missing:
        x[rng.random((n, 4)) < 0.05] = np.nan
    return [(i, *map(float, x[i]), int(y[i]), 1.0 + 1.5 * int(y[i])) for i in range(n)]


def plain(data, params):
    """Trees as {node: (feature, threshold, value, rows)}, all sums over whole columns in numpy."""
    ids = [r[0] for r in data]
    x = np.array([r[1:5] for r in data])
    y, w = np.array([r[5] for r in data], float), np.array([r[6] for r in data])
    margin = np.full(len(data), params.base_margin)
    out = []
    for t in range(params.rounds):
        inside = np.array([int(hashlib.md5(f"{params.seed}|{t}|{i}".encode()).hexdigest()[:8], 16)
                           < int(params.row_sample * 2 ** 32) for i in ids])
        columns = boosting.sampled_columns(4, params.seed, t, params.column_sample)
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        tree, add = {}, np.zeros(len(data))

        def score(mask):
            return g[mask].sum() ** 2 / (h[mask].sum() + params.l2)

        def grow(number, reach, depth):
            mine = reach & inside
            best = None
            for j in columns if depth < params.depth else ():
                present = x[~np.isnan(x[:, j]), j]
                for cut in sorted(set(np.quantile(present, [i / params.bins for i in range(1, params.bins)],
                                                  method="inverted_cdf"))):
                    low, high = mine & (x[:, j] <= cut), mine & ~(x[:, j] <= cut)
                    if not low.any() or not high.any() or min(h[low].sum(), h[high].sum()) < params.min_child_weight:
                        continue
                    gain = 0.5 * (score(low) + score(high) - score(mine))
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-10):
                        best = (gain, j, cut)
            value = -params.learning_rate * g[mine].sum() / (h[mine].sum() + params.l2)
            tree[number] = (None, None, value, int(mine.sum()))
            if best is None:
                add[reach] = value
                return
            _, j, cut = best
            tree[number] = (j, cut, value, int(mine.sum()))
            grow(2 * number + 1, reach & (x[:, j] <= cut), depth + 1)
            grow(2 * number + 2, reach & ~(x[:, j] <= cut), depth + 1)

        grow(0, np.ones(len(data), bool), 0)
        margin = margin + add
        out.append(tree)
    return out, margin


PARAMS = BoostParams(rounds=7, depth=3, bins=32, save_every=3, min_child_weight=2.0, column_sample=0.75)


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df, boosting.fit(df, COLS, weight="w", params=PARAMS)


def test_equal_to_a_plain_version(spark, fitted):
    df, model = fitted
    want, margin = plain(rows(), PARAMS)
    assert any(n["feature"] is not None and n["node"] >= 3 for n in model.nodes)    # grown to the last level
    for t, tree in enumerate(want):
        got = {n["node"]: n for n in model.nodes if n["tree"] == t}
        assert set(got) == set(tree)
        for number, (feature, cut, value, count) in tree.items():
            assert (got[number]["feature"], got[number]["threshold"], got[number]["rows"]) == (feature, cut, count)
            assert got[number]["prediction"] == pytest.approx(value, abs=1e-9)
    scored = {r.member_id: r.margin for r in model.score(df).collect()}
    assert [scored[i] for i in range(300)] == pytest.approx(list(margin), abs=1e-9)


def test_children_hold_their_parent_and_the_least_weight(fitted):
    _, model = fitted
    at = {(n["tree"], n["node"]): n for n in model.nodes}
    for n in model.nodes:
        if n["feature"] is not None:
            low, high = at[n["tree"], n["low"]], at[n["tree"], n["high"]]
            assert low["rows"] + high["rows"] == n["rows"] and low["hessian"] + high["hessian"] == n["hessian"]
            assert min(low["hessian"], high["hessian"]) >= PARAMS.min_child_weight


@pytest.mark.parametrize("parts", [1, 7])
def test_trees_do_not_depend_on_the_layout(spark, fitted, parts):
    df, model = fitted
    again = boosting.fit(df.repartition(parts, F.rand(parts)), COLS, weight="w", params=PARAMS)
    assert again.nodes == model.nodes and again.cuts == model.cuts


def test_joins_over_the_node_table_give_the_same_margin(spark, fitted):
    df, model = fitted
    x = VectorAssembler(inputCols=COLS, outputCol="v", handleInvalid="keep").transform(df).select(
        "member_id", vector_to_array("v").alias("x"))
    leaves = trees.reached_leaves(x, model.table(spark), PARAMS.rounds, PARAMS.depth)
    got = leaves.groupBy("member_id").agg(F.sum("prediction").alias("by_joins"))
    wrong = model.score(df).join(got, "member_id").where("abs(margin - by_joins) > 1e-12").count()
    assert wrong == 0 and got.count() == 300


def test_loss_falls_and_a_shuffled_label_is_not_learnt(spark):
    df = spark.createDataFrame(rows(missing=False), SCHEMA)
    short, longer = (boosting.fit(df, COLS, params=BoostParams(rounds=r, depth=3, bins=32)) for r in (1, 15))
    assert boosting.log_loss(longer.score(df)) < boosting.log_loss(short.score(df)) < np.log(2)
    constant = boosting.fit(df.withColumn("is_churned", F.lit(1)), COLS, params=BoostParams(rounds=2, depth=3, bins=8))
    assert all(n["feature"] is None for n in constant.nodes)    # nothing to part: leaves only


def test_edge_rows(spark):
    params = BoostParams(rounds=2, depth=2, bins=8, min_child_weight=0.1)
    empty = boosting.fit(spark.createDataFrame([], SCHEMA), COLS, params=params)
    assert [(n["tree"], n["feature"], n["prediction"]) for n in empty.nodes] == [(0, None, 0.0), (1, None, 0.0)]
    some = rows(60)
    odd = [(None, 1.0, None, float("nan"), None, 1, 1.0), (7, 1.0, 1.0, 1.0, None, None, 1.0), (8, 1.0, 1.0, 1.0, None, 0, None)]
    df = spark.createDataFrame([(*r[:4], None, *r[5:]) for r in some] + odd, SCHEMA)    # d never has a value
    model = boosting.fit(df, COLS, weight="w", params=params)
    assert model.cuts[3] == [] and all(n["feature"] != 3 for n in model.nodes)
    assert all(n["rows"] <= 61 for n in model.nodes)    # no label or no weight: no part
    assert model.score(df).where("score IS NULL OR isnan(score)").count() == 0


def test_whole_numbers_are_added_exactly_and_trees_are_walked():
    numbers = np.array([2 ** 60 + 1, -3, 2 ** 59 + 7, -(2 ** 60), 5])
    assert boosting._added(np.array([0, 0, 2, 1, 1]), numbers, 4).tolist() == [2 ** 60 - 2, 5 - 2 ** 60, 2 ** 59 + 7, 0]
    leaf = dict(feature=None, bin=None, low=None, high=None)
    tree = boosting._Tree([dict(node=0, feature=1, bin=3, low=1, high=2, prediction=0.0),
                           dict(node=1, prediction=-1.0, **leaf), dict(node=2, prediction=2.0, **leaf)])
    at = tree.reached(np.array([[9, 3], [0, 4]]))
    assert at.tolist() == [1, 2] and tree.value[at].tolist() == [-1.0, 2.0]
