import datetime as dt

from conftest import AS_OF, make_activity, member_row

from cohortlens import constants as K
from cohortlens.operators import features
from cohortlens.operators.features import feature_table


def d(days_before):
    return AS_OF - dt.timedelta(days=days_before)


def test_member_without_logs_gets_zeros_and_sentinels(spark):
    data = make_activity(spark, [member_row(1)])
    row = feature_table(data).first().asDict()
    for c in K.ACTIVITY_COLUMNS:
        assert row[c] == 0
    for c in K.RECENCY_COLUMNS:
        assert row[c] == K.RECENCY_SENTINEL
    assert row["avg_calories_per_meal"] is None and row["avg_bmi"] is None
    assert row["collection_completion_rate"] == 0.0
    assert row["enrollment_age_days"] is None


def test_meal_windows_are_inclusive_and_future_logs_dropped(spark):
    meals = [(1, d(0), "b", 100.0, 1.0, 1.0, 1.0, True), (1, d(7), "l", 200.0, 1.0, 1.0, 1.0, False),
             (1, d(14), "d", 300.0, 1.0, 1.0, 1.0, True), (1, d(15), "d", 400.0, 1.0, 1.0, 1.0, True),
             (1, d(-1), "x", 9999.0, 1.0, 1.0, 1.0, True)]
    data = make_activity(spark, [member_row(1)], meals=meals)
    row = feature_table(data).first().asDict()
    assert row["total_meal_logs"] == 4
    assert row["meals_last_7_days"] == 2
    assert row["meals_last_14_days"] == 3
    assert row["days_since_last_meal"] == 0
    assert row["avg_calories_per_meal"] == 250.0
    assert row["meal_compliance_rate"] == 0.75
    assert row["distinct_meal_types"] == 3


def test_weight_change_uses_date_then_id_order_and_bmi(spark):
    weights = [(1, d(10), 1, 80.0), (1, d(10), 2, 82.0), (1, d(3), 5, 79.0), (1, d(20), 9, 85.0)]
    data = make_activity(spark, [member_row(1, height=200.0)], weights=weights)
    row = feature_table(data).first().asDict()
    assert row["weight_change_kg"] == round(79.0 - 85.0, 2)
    assert row["weight_range_kg"] == 6.0
    assert row["avg_bmi"] == round((80 + 82 + 79 + 85) / 4 / 4.0, 1)
    assert row["distinct_weight_days"] == 3
    assert row["days_since_last_weight"] == 3


def test_zero_height_gives_null_bmi(spark):
    data = make_activity(spark, [member_row(1, height=0.0)], weights=[(1, d(1), 1, 80.0)])
    assert feature_table(data).first()["avg_bmi"] is None


def test_collections_and_enrollment(spark):
    enr = [(1, d(30), True, 7, None, 3)]
    coll = [(1, 10, d(2), True, True, 100.0), (1, 11, d(5), False, True, 50.0),
            (1, 12, d(9), False, False, 0.0)]
    data = make_activity(spark, [member_row(1)], enrollments=enr, collections=coll)
    row = feature_table(data).first().asDict()
    assert (row["total_collection_items"], row["completed_items"], row["unlocked_items"]) == (3, 1, 2)
    assert row["collection_completion_rate"] == 0.3333
    assert row["avg_progress_percent"] == 50.0
    assert row["days_since_last_collection"] == 2
    assert row["enrollment_age_days"] == 30 and row["is_enrolled_active"] == 1
    assert (row["has_doctor"], row["has_nutritionist"], row["has_fitness_coach"]) == (1, 0, 1)


def test_every_member_appears_once(spark):
    from cohortlens.sources.standin import orders_profile
    from conftest import SF001
    t = feature_table(orders_profile(spark, SF001))
    assert t.count() == t.select("member_id").distinct().count() == 150
    bad = t.where("meals_last_7_days > meals_last_14_days or distinct_meal_days > total_meal_logs"
                  " or completed_items > unlocked_items or unlocked_items > total_collection_items")
    assert bad.count() == 0


def test_enrollment_ties_take_one_whole_row_in_any_order(spark):
    rows = [(1, AS_OF, True, 7, None, None), (1, AS_OF, False, None, 8, None), (1, None, True, 9, 9, 9)]
    for order in (rows, rows[::-1]):
        data = make_activity(spark, [member_row(1)], enrollments=order)
        r = features.enrollment_features(data.enrollments.coalesce(1), AS_OF).first()
        assert (r.is_enrolled_active, r.has_doctor, r.has_nutritionist, r.has_fitness_coach) == (1, 1, 0, 0)


def test_weights_without_a_value_are_not_first_or_last(spark):
    days = [AS_OF - dt.timedelta(days=d) for d in (9, 5, 1)]
    data = make_activity(spark, [member_row(1)], weights=[
        (1, days[0], 1, None), (1, days[0], 2, 80.0), (1, days[1], 3, 70.0), (1, days[2], 4, None)])
    r = features.weight_features(data.weights, data.members, AS_OF).first()
    assert (r.weight_range_kg, r.weight_change_kg, r.total_weight_logs) == (10.0, -10.0, 4)


def test_nan_is_missing(spark):
    data = make_activity(spark, [member_row(1)], meals=[
        (1, AS_OF, "b", float("nan"), 1.0, 1.0, 1.0, True), (1, AS_OF, "b", 100.0, 1.0, 1.0, 1.0, True)])
    assert features.meal_features(data.meals, AS_OF).first().avg_calories_per_meal == 100.0


def test_no_expand_on_the_logs(spark):
    data = make_activity(spark, [member_row(1)])
    for df in (features.meal_features(data.meals, AS_OF), features.exercise_features(data.exercises, AS_OF)):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_member_with_a_third_of_the_log_and_one_shuffle_a_channel(spark):
    """Counts equal plain Python; a channel's log is shuffled once, by member."""
    rows = [(1 if i % 3 == 0 else i % 40 + 2, d(i % 900), "bld"[i % 3], float(i % 7), None, 1.0, 1.0, i % 5 == 0)
            for i in range(3000)]
    work = [(r[0], r[1], r[2], i % 50, 1.5, i % 9) for i, r in enumerate(rows)]
    data = make_activity(spark, [member_row(1)], meals=rows, exercises=work)
    meals = features.meal_features(data.meals.repartition(7), AS_OF)
    moves = features.exercise_features(data.exercises.repartition(7), AS_OF)
    for got, days, kinds, total in ((meals, "distinct_meal_days", "distinct_meal_types", "total_meal_logs"),
                                    (moves, "distinct_exercise_days", "distinct_exercise_types", "total_exercise_logs")):
        found = {r.member_id: (r[total], r[days], r[kinds]) for r in got.collect()}
        want = {m: (sum(r[0] == m for r in rows), len({r[1] for r in rows if r[0] == m}),
                    len({r[2] for r in rows if r[0] == m})) for m in {r[0] for r in rows}}
        assert found == want
    for df in (features.meal_features(data.meals, AS_OF), features.exercise_features(data.exercises, AS_OF)):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_channel_recency_equals_the_feature_table(spark):
    data = make_activity(spark, [member_row(1), member_row(2)], weights=[(1, d(4), 1, 80.0), (1, d(-2), 2, 80.0)],
                         collections=[(1, 5, d(9), True, True, 1.0)], meals=[(7, d(1), "b", 1.0, 1.0, 1.0, 1.0, True)])
    got = features.channel_recency(data)
    table = feature_table(data).select("member_id", *K.RECENCY_COLUMNS)
    assert sorted(got.collect()) == sorted(table.collect())
    assert got.schema.simpleString() == table.schema.simpleString()
