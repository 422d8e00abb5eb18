import datetime as dt

from conftest import AS_OF, SF01, make_activity, member_row

from cohortlens.operators import timeline


def test_zero_filled_31_days_and_active_rule(spark):
    day = AS_OF - dt.timedelta(days=3)
    data = make_activity(
        spark, [member_row(1), member_row(2)],
        enrollments=[(1, AS_OF - dt.timedelta(days=40), True, None, None, None)],
        meals=[(1, AS_OF, "b", 1.0, 1.0, 1.0, 1.0, True), (1, AS_OF, "l", 1.0, 1.0, 1.0, 1.0, True),
               (1, AS_OF - dt.timedelta(days=31), "old", 1.0, 1.0, 1.0, 1.0, True)],
        collections=[(1, 7, day, False, True, 10.0)])
    daily = timeline.daily_activity(data)
    assert daily.count() == 62
    s = {r.member_id: r for r in timeline.timeline_summary(timeline.member_days(data)).collect()}
    assert s[1].active_days == 1 and s[1].total_meals_logged == 2 and s[1].activity_rate == round(1 / 31, 4)
    assert s[2].active_days == 0
    t = {r.member_id: r for r in timeline.member_timeline(data).collect()}
    assert len(t[1].activity_timeline) == 31
    assert t[1].activity_timeline[-1].date == AS_OF.isoformat()
    assert t[1].activity_timeline[-4].collection_progress == 1
    assert t[1].enrollment_date == (AS_OF - dt.timedelta(days=40)).isoformat()
    assert t[2].enrollment_date is None


def test_events_profile_grid(spark):
    from cohortlens.sources.standin import events_profile
    daily = timeline.daily_activity(events_profile(spark, SF01))
    per = daily.groupBy("member_id").count().select("count").distinct().collect()
    assert [r["count"] for r in per] == [31]
