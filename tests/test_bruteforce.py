"""Feature aggregation against a pandas brute force on random logs where one
member holds a third of all rows; output must not depend on partitioning."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import AS_OF, make_activity, member_row

from cohortlens.operators.features import feature_table


def random_logs(seed=11, members=40, meals=900):
    rng = np.random.default_rng(seed)
    ids = np.where(rng.random(meals) < 1 / 3, 0, rng.integers(1, members, meals))
    days = rng.integers(-3, 60, meals)  # negative: after as_of, must be dropped
    rows = []
    for i, (m, d) in enumerate(zip(ids, days)):
        cal = None if rng.random() < 0.1 else float(rng.integers(100, 900))
        rows.append((int(m), AS_OF - dt.timedelta(days=int(d)), "bld"[i % 3], cal,
                     float(rng.integers(1, 50)), 10.0, 5.0, bool(rng.random() < 0.5)))
    weights = [(int(m), AS_OF - dt.timedelta(days=int(d)), int(k), float(rng.integers(50, 120)))
               for k, (m, d) in enumerate(zip(np.where(rng.random(300) < 1 / 3, 0, rng.integers(1, members, 300)),
                                              rng.integers(0, 40, 300)))]
    return rows, weights


def hround(x, digits):
    """Decimal half-up on the shortest repr (Spark's and DuckDB's rounding)."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(float(x))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def brute(meals, weights, members):
    m = pd.DataFrame(meals, columns=["member_id", "log_date", "meal_type", "calories", "protein_g",
                                     "carbs_g", "fat_g", "is_compliant"])
    m = m[m.log_date <= AS_OF]
    age = m.log_date.map(lambda d: (AS_OF - d).days)
    out = {}
    for mid in range(members):
        g = m[m.member_id == mid]
        a = age[m.member_id == mid]
        out[mid] = dict(
            total_meal_logs=len(g), distinct_meal_days=g.log_date.nunique(),
            avg_calories_per_meal=None if g.calories.notna().sum() == 0 else hround(g.calories.mean(), 1),
            meals_last_7_days=int(((a >= 0) & (a <= 7)).sum()),
            meal_compliance_rate=None if len(g) == 0 else hround(g.is_compliant.mean(), 4),
            days_since_last_meal=9999 if len(g) == 0 else int(a.min()))
    w = pd.DataFrame(weights, columns=["member_id", "log_date", "log_id", "weight_kg"])
    for mid in range(members):
        g = w[w.member_id == mid].sort_values(["log_date", "log_id"])
        out[mid]["total_weight_logs"] = len(g)
        out[mid]["weight_change_kg"] = None if len(g) == 0 else hround(g.weight_kg.iloc[-1] - g.weight_kg.iloc[0], 2)
        out[mid]["distinct_weight_days"] = g.log_date.nunique()
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_feature_table_matches_brute_force_with_hot_member(spark, parts):
    members = 40
    meals, weights = random_logs(members=members)
    data = make_activity(spark, [member_row(i) for i in range(members)], meals=meals, weights=weights)
    data = data.__class__(**{**data.__dict__, "meals": data.meals.repartition(parts),
                             "weights": data.weights.repartition(parts)})
    got = {r.member_id: r.asDict() for r in feature_table(data).collect()}
    want = brute(meals, weights, members)
    for mid, exp in want.items():
        for k, v in exp.items():
            g = got[mid][k]
            if v is None:
                assert g is None, (mid, k)
            else:
                assert g == pytest.approx(v), (mid, k, g, v)
