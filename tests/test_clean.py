import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.operators import clean, quantiles
from cohortlens.operators.quantiles import exact_quantiles


def test_clip_matches_linear_interpolation(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 10, 50)], "member_id long, x double")
    bounds = clean.fit_clip_bounds(df)
    lo, hi = bounds["x"]
    assert lo == pytest.approx(1.03) and hi == pytest.approx(48.8)
    vals = sorted(r.x for r in clean.apply_clip_bounds(df, bounds).collect())
    assert vals[0] == pytest.approx(1.03) and vals[-1] == pytest.approx(48.8)


def test_impute_by_name(spark):
    df = spark.createDataFrame(
        [(1, None, None, None, 1.0), (2, 20.0, 5, 3, None), (3, 30.0, 7, 4, None), (4, 40.0, None, None, None)],
        "member_id long, avg_bmi double, total_steps long, days_since_last_meal int, all_null_x double")
    df = df.withColumn("all_null_x", df.all_null_x * 0 + None)
    out = {r.member_id: r for r in clean.impute_by_name(df).collect()}
    assert out[1].avg_bmi == 30.0
    assert out[1].total_steps == 0 and out[4].days_since_last_meal == 0
    assert out[1].all_null_x is None


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a long, b long")
    rows = clean.null_profile(df).collect()
    assert [(r.column_name, r.missing_count, r.row_count) for r in rows] == [("b", 1, 2)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.integers(-5, 5).map(float),
                          st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=300))
def test_exact_quantiles_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(quantiles, "ACCURACY", 25)  # coarse sketches, so several rounds are needed
        got = exact_quantiles(df, ["x"], [0.01, 0.5, 0.99])["x"]
    want = np.quantile(np.array(values), [0.01, 0.5, 0.99])
    assert got == pytest.approx(list(want), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("accuracy", [25, 10_000])
def test_exact_quantiles_ties_nan_and_wide_scales(spark, monkeypatch, accuracy):
    """Bounded rounds and reads also with NaN, with e^+-700 and with a crowd of equal values."""
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    tied = [0.0] * 500 + [float(v) for v in np.linspace(1, 2, 200)] + [1e9]
    wide = [float(np.exp(v)) for v in np.linspace(-700, 700, 701)]
    rows = [(a, b, float("nan") if i % 7 == 0 else a, None) for i, (a, b) in enumerate(zip(tied, wide))]
    df = spark.createDataFrame(rows, "tied double, wide double, nan double, none double")
    rounds = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda data, active: (rounds.append(len(active)), narrow(data, active)))
    probs = [0.0, 0.01, 0.5, 0.9, 0.999, 1.0]
    got = exact_quantiles(df, ["tied", "wide", "nan", "none"], probs)
    assert got["tied"] == pytest.approx(list(np.quantile(tied, probs)))
    assert got["wide"] == pytest.approx(list(np.quantile(wide, probs)))
    assert got["nan"] == pytest.approx(list(np.quantile([a for i, a in enumerate(tied) if i % 7], probs)))
    assert got["none"] == [None] * 6
    assert len(rounds) <= 6


def _with_gaps(seed, n):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n) * 10
    gap = rng.random(n)
    rows = []
    for i in range(n):
        hole = None if gap[i] < .1 else float("nan") if gap[i] < .2 else float(x[i])
        rows.append((i, hole, None if gap[i] > .7 else int(x[i]), hole, float(round(x[i])),
                     None if gap[i] < .995 else 1.0, float("nan") if i % 2 else None))
    return rows


@pytest.mark.parametrize("seed,n", [(1, 1000), (2, 37), (3, 2)])
def test_nan_is_missing_in_every_step(spark, seed, n):
    """Profile, fill and clip against pandas, through the operators."""
    pd = pytest.importorskip("pandas")
    schema = "member_id long, avg_x double, step_count int, total_x double, full double, rare double, none double"
    rows = _with_gaps(seed, n)
    df = spark.createDataFrame(rows, schema).repartition(3)
    table = pd.DataFrame(rows, columns=df.columns).astype(float)
    profile = {r.column_name: r.missing_count for r in clean.null_profile(df).collect()}
    assert profile == {c: int(v) for c, v in table.isna().sum().items() if v}
    fill = {"step_count": 0.0, "total_x": 0.0} | {c: table[c].median() for c in ("avg_x", "full", "rare", "none")}
    imputed = table.fillna(fill)
    got = clean.impute_by_name(df).toPandas().sort_values("member_id").astype(float)
    pd.testing.assert_frame_equal(got.reset_index(drop=True), imputed, check_exact=False, rtol=1e-12)
    want = imputed.copy()
    for c in want.columns[1:]:
        want[c] = imputed[c].clip(*imputed[c].quantile([.01, .99]))
    out = clean.handle_missing_and_outliers(df)
    got = out.toPandas().sort_values("member_id").astype(float).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_exact=False, rtol=1e-12)
    assert out.filter("none IS NOT NULL").count() == 0
    clipped = clean.clip_quantiles(df).toPandas().sort_values("member_id").astype(float).reset_index(drop=True)
    for c in ("avg_x", "step_count", "full"):
        pd.testing.assert_series_equal(clipped[c], table[c].clip(*table[c].quantile([.01, .99])), rtol=1e-12)


def test_fit_takes_three_passes(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    df = spark.createDataFrame(_with_gaps(4, 500), "member_id long, a double, b int, c_total double, d double, e double, f double")
    calls = []
    for name in ("first", "collect"):
        monkeypatch.setattr(DataFrame, name, lambda self, *a, f=getattr(DataFrame, name), n=name: (calls.append(n), f(self, *a))[1])
    clean.fit_missing_and_outliers(df)
    assert calls == ["collect"] * 3
