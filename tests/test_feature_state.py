"""Feature state after daily merges against the full run over all logs."""

import datetime as dt

import numpy as np
import pytest
from conftest import AS_OF, make_activity, member_row

from cohortlens.operators import feature_state, features
from cohortlens.sources.activity import log_batch

MEMBERS = 12


def day(age):
    return AS_OF - dt.timedelta(days=int(age))


def logs(seed=4, n=400):
    rng = np.random.default_rng(seed)

    def member():   # member 0 holds a third; the last one has none
        return 0 if rng.random() < 1 / 3 else int(rng.integers(1, MEMBERS - 1))

    def some(x):
        return None if rng.random() < 0.1 else x
    ages = rng.integers(-2, 40, n)
    return dict(
        meals=[(member(), day(a), some("bld"[i % 3]), some(float(rng.integers(100, 900))), 7.0, some(9.5), 5.0,
                some(bool(rng.random() < 0.5))) for i, a in enumerate(ages)],
        weights=[(member(), day(a), i, some(float(rng.integers(50, 120)))) for i, a in enumerate(ages)],
        exercises=[(member(), day(a), some("xyz"[i % 3]), some(int(rng.integers(5, 90))), some(float(rng.integers(9, 99))),
                    some(int(rng.integers(0, 9999)))) for i, a in enumerate(ages)],
        collections=[(member(), i, day(a), some(bool(i % 2)), bool(i % 3), some(float(rng.integers(0, 100))))
                     for i, a in enumerate(ages)])


def activity(spark, rows, as_of=AS_OF):
    people = [member_row(m) for m in range(MEMBERS)]
    return make_activity(spark, people, [(1, day(90), True, 5, None, 6)], as_of=as_of, **rows)


def table(df):
    return {r.member_id: tuple(r) for r in df.collect()}


def full(spark, rows, as_of=AS_OF):
    return table(features.feature_table(activity(spark, rows, as_of)))


def state_table(spark, root, data, as_of=AS_OF):
    return table(feature_state.feature_table(spark, root, as_of, data.members, data.enrollments))


def run(spark, root, data, days):
    before = None
    for d in days:
        feature_state.advance(spark, root, log_batch(data, before, d), before)
        before = d


def test_daily_merges_equal_the_full_run(spark, tmp_path):
    rows = logs()
    data = activity(spark, rows)
    days = [day(a) for a in (20, 9, 2, 1, 0)]   # steps of several days, some longer than the counted age
    run(spark, str(tmp_path), data, days)
    for d in (days[1], days[-1]):
        assert state_table(spark, str(tmp_path), data, d) == full(spark, rows, d)


def test_a_batch_run_again_gives_the_same_and_needs_the_one_before(spark, tmp_path):
    rows = logs(seed=8, n=120)
    data = activity(spark, rows)
    run(spark, str(tmp_path), data, [day(3), day(0)])
    feature_state.advance(spark, str(tmp_path), log_batch(data, day(3), day(0)), day(3))
    assert state_table(spark, str(tmp_path), data) == full(spark, rows)
    with pytest.raises(FileNotFoundError):
        feature_state.advance(spark, str(tmp_path), log_batch(data, day(2), day(1)), day(2))
    with pytest.raises(ValueError):
        feature_state.advance(spark, str(tmp_path), log_batch(data, day(0), day(0)), day(0))


def test_late_logs_and_empty_batches(spark, tmp_path):
    rows = logs(seed=9, n=150)
    early = {k: [r for i, r in enumerate(v) if i % 2] for k, v in rows.items()}
    late = {k: [r for i, r in enumerate(v) if not i % 2] for k, v in rows.items()}
    root, nothing = str(tmp_path), activity(spark, {}, day(2))
    feature_state.advance(spark, root, nothing, None)
    feature_state.advance(spark, root, activity(spark, early, day(1)), day(2))
    feature_state.advance(spark, root, activity(spark, late, AS_OF), day(1))   # half of them dated before day 1
    seen = {k: [r for i, r in enumerate(v) if not i % 2 or r[2 if k == "collections" else 1] <= day(1)]
            for k, v in rows.items()}
    assert state_table(spark, root, nothing) == full(spark, seen)


def test_the_feature_table_of_a_state_reads_no_log(spark, tmp_path):
    data = activity(spark, logs(n=60))
    run(spark, str(tmp_path), data, [AS_OF])
    df = feature_state.feature_table(spark, str(tmp_path), AS_OF, data.members, data.enrollments)
    files = [f for f in df.inputFiles() if f.endswith(".parquet")]
    assert files and all("/state-" in f for f in files)


@pytest.mark.parametrize("limit", [0, 500_000])
def test_a_batch_is_merged_alike_with_and_without_a_shuffle_of_the_state(spark, monkeypatch, limit):
    """A null member in both, a member of the state alone, one of the batch alone; recent meals age everywhere."""
    monkeypatch.setattr(feature_state, "BROADCAST_MEMBERS", limit)
    data = activity(spark, dict(logs(n=60), meals=[
        (m, day(a), "b", 1.0, 1.0, 1.0, 1.0, True) for m, a in ((None, 5), (None, 1), (3, 4), (4, 1))]))
    old = feature_state.partial("meals", log_batch(data, None, day(3)).meals, day(3))
    new = feature_state.partial("meals", log_batch(data, day(3), day(0)).meals, day(0))
    merged = feature_state.merge_batch("meals", old, new, new.count(), day(0))
    got = {r.member_id: (r.n, [i for i, x in enumerate(r.recent) if x], r.as_of) for r in merged.collect()}
    assert got == {None: (2, [1, 5], day(0)), 3: (1, [4], day(0)), 4: (1, [1], day(0))}
    if limit:   # the rows of the state reach the result without an exchange of their own
        assert "LeftAnti" in merged._jdf.queryExecution().toString()
