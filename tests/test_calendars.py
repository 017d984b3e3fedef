from datetime import date, datetime, timedelta, timezone

import pytest
from frames import plan_of, tuples
from pyspark.sql import functions as F

from daymill.plans import calendars as C

# The holidays of the skipping calendars.
HOLIDAYS = [date(2026, 2, 16), date(2026, 2, 17), date(2026, 2, 18)]


def day(month, number):
    return datetime(2026, month, number)


def spans(calendar):
    return [(s, e) for s, e, _ in tuples(calendar.select(*C.COLUMNS))]


def test_daily(spark):
    bounds = C.fixed_bounds(spark, date(2026, 2, 10), date(2026, 2, 12))
    assert tuples(C.daily_calendar(bounds)) == [
        (day(2, d), day(2, d + 1), day(2, d)) for d in (10, 11, 12)
    ]


def test_bounds_within_a_day_start_at_the_next_midnight(spark):
    bounds = C.fixed_bounds(spark, "2026-02-10 00:00:00.000001", "2026-02-12 23:59:59")
    assert [s for s, _ in spans(C.daily_calendar(bounds))] == [day(2, 11), day(2, 12)]


def test_bounds_without_a_midnight_give_no_run(spark):
    bounds = C.fixed_bounds(spark, "2026-02-10 01:00:00", "2026-02-10 23:00:00")
    assert C.daily_calendar(bounds).count() == 0


def test_aware_bounds_are_read_in_the_zone(spark):
    first = datetime(2026, 2, 9, 15, tzinfo=timezone.utc)
    bounds = C.fixed_bounds(spark, first, first, "Asia/Seoul")
    assert spans(C.daily_calendar(bounds)) == [(day(2, 10), day(2, 11))]


def test_cron_interval_tuesday_to_saturday(spark):
    bounds = C.fixed_bounds(spark, date(2026, 1, 1), "2026-01-06 23:59:59")
    assert spans(C.cron_interval_calendar(bounds, range(2, 7))) == [
        (day(1, 1), day(1, 2)), (day(1, 2), day(1, 3)), (day(1, 3), day(1, 6)), (day(1, 6), day(1, 7)),
    ]


def test_cron_interval_monday_to_friday(spark):
    bounds = C.fixed_bounds(spark, date(2026, 1, 1), "2026-01-06 23:59:59")
    assert spans(C.cron_interval_calendar(bounds, range(1, 6))) == [
        (day(1, 1), day(1, 2)), (day(1, 2), day(1, 5)), (day(1, 5), day(1, 6)), (day(1, 6), day(1, 7)),
    ]


def test_cron_interval_equals_the_next_run_found_by_sorting(spark):
    bounds = C.fixed_bounds(spark, date(2024, 1, 1), date(2024, 12, 31))
    for days in ([0], [3, 5], range(7)):
        starts = [s for s, _ in spans(C.cron_interval_calendar(bounds, days))]
        ends = [e for _, e in spans(C.cron_interval_calendar(bounds, days))]
        assert ends[:-1] == starts[1:]
        assert ends[-1] > datetime(2024, 12, 31)


def test_cron_point(spark):
    bounds = C.fixed_bounds(spark, date(2026, 2, 13), date(2026, 2, 18))
    got = tuples(C.cron_point_calendar(bounds, range(2, 7)).select("logical_date", "interval_start", "interval_end"))
    assert got == [(day(2, d), day(2, d - 1), day(2, d)) for d in (13, 14, 17, 18)]


@pytest.mark.parametrize("days", [[], [7], [-1, 2]])
def test_days_that_do_not_exist_are_refused(spark, days):
    with pytest.raises(ValueError, match="days"):
        C.cron_point_calendar(C.fixed_bounds(spark, date(2026, 1, 1), date(2026, 1, 2)), days)


def test_business_intervals(spark):
    bounds = C.fixed_bounds(spark, date(2026, 2, 6), "2026-02-20 23:59:59")
    got = [s.day for s, _ in spans(C.business_interval_calendar(bounds, HOLIDAYS))]
    assert got == [6, 9, 10, 11, 12, 13, 19, 20]


def test_business_points(spark):
    bounds = C.fixed_bounds(spark, date(2026, 2, 6), "2026-02-20 23:59:59")
    got = [s.day for s, _ in spans(C.business_point_calendar(bounds, HOLIDAYS))]
    assert got == [5, 6, 9, 10, 11, 12, 13, 19]


def test_holidays_from_a_table(spark):
    bounds = C.fixed_bounds(spark, date(2026, 2, 6), "2026-02-20 23:59:59")
    listed = spark.createDataFrame([(h,) for h in HOLIDAYS] * 2, "holiday DATE")
    assert spans(C.business_interval_calendar(bounds, listed)) == spans(
        C.business_interval_calendar(bounds, HOLIDAYS)
    )
    assert spans(C.business_interval_calendar(bounds, [])) != spans(
        C.business_interval_calendar(bounds, HOLIDAYS)
    )


def test_holiday_matches_midnight_only(spark):
    noon = spark.createDataFrame(
        [(day(2, 16) + timedelta(hours=h),) for h in (0, 12)], "logical_date TIMESTAMP_NTZ"
    ).select(*(F.col("logical_date").alias(c) for c in C.COLUMNS))
    assert spans(C.drop_holidays(noon, HOLIDAYS)) == [(datetime(2026, 2, 16, 12),) * 2]


def test_missing_and_latest(spark):
    calendar = C.daily_calendar(C.fixed_bounds(spark, date(2026, 2, 1), date(2026, 2, 5)))
    done = calendar.where("interval_start IN (TIMESTAMP_NTZ '2026-02-01', TIMESTAMP_NTZ '2026-02-03')")
    assert [s.day for s, _ in spans(C.missing_intervals(calendar, done))] == [2, 4, 5]
    now = F.lit("2026-02-04 00:00:00").cast("timestamp_ntz")
    assert spans(C.latest_interval(calendar, now)) == [(day(2, 3), day(2, 4))]
    assert "TakeOrderedAndProject" in plan_of(C.latest_interval(calendar, now))


def test_utc_bounds_and_run_dates(spark):
    calendar = C.daily_calendar(C.fixed_bounds(spark, date(2026, 2, 1), date(2026, 2, 1)))
    row = C.with_run_dates(C.with_utc_bounds(calendar, "Asia/Seoul"), "Asia/Seoul").first()
    assert (row.start_utc, row.end_utc) == (datetime(2026, 1, 31, 15), datetime(2026, 2, 1, 15))
    assert (row.ds, row.ts_nodash) == ("2026-01-31", "20260131T150000")


def test_bounds_from_data(spark, orders):
    facts = orders(("2026-02-03 05:00:00", 1), ("2026-02-01 23:00:00", 1), (None, 1))
    for bounds in (C.data_bounds(facts, "order_dt"), C.observed_bounds(facts, "order_dt")):
        assert tuple(bounds.first()) == (day(2, 1), day(2, 3))
    for bounds in (C.data_bounds, C.observed_bounds):
        assert C.daily_calendar(bounds(facts.where("false"), "order_dt")).count() == 0


def test_calendars_do_not_depend_on_the_session_zone(spark, any_session_zone):
    bounds = C.fixed_bounds(spark, date(2024, 3, 8), date(2024, 3, 13))
    assert [s.day for s, _ in spans(C.daily_calendar(bounds))] == list(range(8, 14))
