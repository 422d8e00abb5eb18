import datetime as dt
import re

from conftest import AS_OF, make_activity, member_row

from cohortlens.operators import timeline
from cohortlens.sources import daylogs


def day(age):
    return AS_OF - dt.timedelta(days=age)


def activity(spark, meals):
    return make_activity(spark, [member_row(m) for m in range(4)], meals=meals,
                         weights=[(1, day(3), 7, 70.5), (2, day(200), 8, 60.0), (1, None, 9, 61.0)],
                         exercises=[(3, day(a), "run", 30, 2.5, 100) for a in range(0, 300, 7)])


def meal(member, age, calories=100.0):
    return (member, day(age), "b", calories, 1.0, None, 2.0, True)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_logs_come_back_and_a_window_reads_its_days_only(spark, tmp_path):
    data = activity(spark, [meal(0, a % 120) for a in range(300)])    # one member holds most rows
    daylogs.write_by_day(data, str(tmp_path), files_per_day=3)
    back = daylogs.read_by_day(spark, str(tmp_path), data)
    for channel in daylogs.CHANNELS:
        assert rows(getattr(back, channel)) == rows(getattr(data, channel))
    assert rows(timeline.daily_activity(back)) == rows(timeline.daily_activity(data))
    recent = daylogs.read_by_day(spark, str(tmp_path), data, last_days=31)
    assert rows(timeline.daily_activity(recent)) == rows(timeline.daily_activity(data))
    plan = recent.meals._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*log_date", plan)
    scanned = recent.meals.select("_metadata.file_path").distinct().collect()
    days = {re.search(r"log_date=([\d-]+)", r.file_path)[1] for r in scanned}
    assert days == {day(a).isoformat() for a in range(31)}


def test_writing_a_day_again_leaves_the_others(spark, tmp_path):
    daylogs.write_by_day(activity(spark, [meal(0, 0), meal(1, 1)]), str(tmp_path))
    again = activity(spark, [meal(2, 0, 5.0), meal(2, 0, 5.0)])
    daylogs.write_by_day(again, str(tmp_path))
    got = daylogs.read_by_day(spark, str(tmp_path), again).meals
    assert rows(got.select("member_id", "log_date")) == sorted([(1, day(1)), (2, day(0)), (2, day(0))], key=repr)
    assert rows(daylogs.read_by_day(spark, str(tmp_path), again, day(1), 1).meals.select("member_id")) == [(1,)]
